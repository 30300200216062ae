"""Conversation prefix trie by union-find over sorted-neighbour LCP edges (operator 11).

Every turn is a unit of 20 bytes: MD5 of role and text, and the words of the text.  A
conversation is the string of its units, cut into segments of ``SEGMENT`` turns; a segment's
string begins with one more unit that stands for all turns before it, so equal first units mean
equal histories, and a string is bounded however long a conversation is.

* Equal strings are collapsed by an aggregate (rows, smallest conversation), so a conversation
  that a third of all rows repeat is one string.
* The distinct strings are range partitioned and sorted.  In a partition, neighbours share an
  edge of their longest common prefix (in units).  Edges are taken in descending depth: the two
  components of an edge are raised to its depth, giving the nodes with one child on the way,
  and united; all that meet at one depth are the children of one branching node.
* A partition knows the last string before it and the first one behind it.  Its nodes on those
  borders may stand in neighbouring partitions too: they are contracted to partial sums (a node
  is owned by the first partition that has it, the others add members only) and merged by
  node id; all other nodes are final where they were made.
* Levels of segments go from the deepest to the first: the totals of the trees that hang on a
  full segment are added at its end.  Conversations of up to ``SEGMENT`` turns are one level.
* Ids of the conversations that end in a node are joined to text in blocks of ids, which a
  last pass, sorted by node and block, streams through SHA-256 (a digest is made in order, by
  one task a node; its rows are ``BLOCK`` times fewer than the ids).

Cases: a null role or text is empty; turns with one number are ordered by their units, null
numbers come first; repeated rows are turns of their own; rows without a conv_id belong to no
conversation; a conversation left without turns ends in the root; an empty table has no nodes;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlens.llm.common import space_words, table, written

UNIT, SEGMENT = 20, 128
#: turn numbers in a window partition; ids in a piece of a digest's text
TURNS, BLOCK = 1024, 4096

NODE = ("id binary, parent binary, depth bigint, units bigint, conv_id bigint, parent_conv_id bigint, "
        "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, open boolean, "
        "parent_open boolean")
_SCHEMA = pa.schema([(n, {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_()}[k])
                     for n, k in (x.split() for x in NODE.split(", "))])


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), unit (hex): turns in order.  A conversation is ordered in parts of
    ``TURNS`` turn numbers, and the parts' sizes give each its first position."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    unit = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                    F.lpad(F.hex(F.size(space_words(text)).cast("bigint")), 8, "0"))
    t = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.lower(unit).alias("unit"),
        F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))).alias("part"))
    n = t.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = n.select("conv_id", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "unit"))
    return t.withColumn("inside", inside).join(before, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("inside")).alias("pos"), "unit")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, pos, unit) after each took its first h turns
    from conversation ``conv_id - conv_id % 20``, h being crc32 of its id modulo 4."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    donor = (F.col("conv_id") - F.pmod("conv_id", F.lit(20))).alias("donor")
    head = turns.filter((F.pmod("conv_id", F.lit(20)) == 0) & (F.col("pos") <= 3))
    convs = turns.select("conv_id").distinct()
    taken = convs.select("conv_id", donor, h.alias("h")).join(
        head.select(F.col("conv_id").alias("donor"), "pos", "unit"), "donor").filter("pos <= h")
    sizes = head.groupBy(F.col("conv_id").alias("donor")).agg(F.max("pos").alias("size"))
    own = turns.select("*", donor, h.alias("h")).filter("pos > h").join(sizes, "donor", "left").select(
        "conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("size", F.lit(0)))).alias("pos"), "unit")
    return convs, taken.select("conv_id", "pos", "unit").unionByName(own)


def _node_id(key: bytes, units: int) -> bytes:
    return key[:16] if units == 1 else hashlib.md5(key[:units * UNIT]).digest()


def _common(a: bytes | None, b: bytes | None) -> int:
    """Units of the longest common prefix."""
    if not a or not b:
        return 0
    n = min(len(a), len(b)) // UNIT
    return next((i for i in range(n) if a[i * UNIT:(i + 1) * UNIT] != b[i * UNIT:(i + 1) * UNIT]), n)


class _Forest:
    """Components of sorted strings; ``top`` is the depth of the node that a component is about
    to become, all deeper ones have been made."""

    def __init__(self, rows: list[dict], before: bytes | None, behind: bytes | None, depth: int):
        self.depth, self.keys = depth, [r["key"] for r in rows]
        self.left, self.right = _common(before, self.keys[0]), _common(self.keys[-1], behind)
        after = self.keys[1:] + [behind]
        self.edges = [_common(a, b) for a, b in zip(self.keys, after)]
        self.up = list(range(len(rows)))
        self.lo, self.hi = self.up[:], self.up[:]
        self.top = [len(k) // UNIT for k in self.keys]
        self.n, self.conv = [r["n"] for r in rows], [r["conv_id"] for r in rows]
        self.kids, self.saved = [r["n_children"] for r in rows], [r["saved_tokens"] for r in rows]
        self.leaves = [r["n_leaves"] if r["n_children"] else int(e < t) for r, e, t in zip(rows, self.edges, self.top)]
        self.waiting: list[list[list]] = [[] for _ in rows]
        self.nodes: list[list] = []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def raise_to(self, c: int, depth: int) -> None:
        """Makes the nodes of component ``c`` below ``depth``, which becomes its top."""
        key = self.keys[c]
        while (u := self.top[c]) > depth:
            words = int.from_bytes(key[u * UNIT - 4:u * UNIT], "big") if u > 1 else 0
            shared = self.lo[c] == 0 and u <= self.left
            is_open = shared or self.hi[c] == len(self.keys) - 1 and u <= self.right
            self.saved[c] += words * (self.n[c] - (not shared))
            known = not is_open and (u > 1 or self.depth == 0)
            for row in self.waiting[c]:
                row[5], row[11] = (self.conv[c], False) if known else (None, True)
            row = [_node_id(key, u), _node_id(key, u - 1) if u > 1 else None, self.depth + u - 1, u,
                   self.conv[c], None, self.n[c], self.kids[c], self.leaves[c], self.saved[c], is_open, u > 1]
            self.nodes.append(row)
            self.waiting[c], self.kids[c], self.top[c] = [row], int(not shared), u - 1

    def unite(self, a: int, b: int) -> None:
        if self.hi[a] - self.lo[a] < self.hi[b] - self.lo[b]:
            a, b = b, a
        self.up[b] = a
        self.lo[a], self.hi[a] = min(self.lo[a], self.lo[b]), max(self.hi[a], self.hi[b])
        self.conv[a] = min(self.conv[a], self.conv[b])
        for x in (self.n, self.kids, self.leaves, self.saved):
            x[a] += x[b]
        self.waiting[a] += self.waiting[b]

    def run(self) -> list[list]:
        for i in sorted(range(len(self.keys) - 1), key=lambda i: -self.edges[i]):
            if not self.edges[i]:
                break
            a, b = self.find(i), self.find(i + 1)
            self.raise_to(a, self.edges[i])
            self.raise_to(b, self.edges[i])
            self.unite(a, b)
        for c in {self.find(i) for i in range(len(self.keys))}:
            self.raise_to(c, 0)
        return self.nodes


def _grow(depth: int):
    def grow(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["key"])
        ends = {r["side"]: r["key"] for r in rows if r["side"]}
        own = [r for r in rows if not r["side"]]
        nodes = _Forest(own, ends.get(-1), ends.get(1), depth).run()
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*nodes), _SCHEMA)], schema=_SCHEMA)
    return grow


def _forests(strings: DataFrame, depth: int) -> DataFrame:
    """Nodes of the distinct ``strings`` (key, n, conv_id, n_children, n_leaves, saved_tokens);
    ``depth``: turns before them."""
    cells = written(strings.repartitionByRange("key").sortWithinPartitions("key").select(
        F.spark_partition_id().alias("part"), "*"), "trie-strings")
    edge = cells.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    w = Window.partitionBy(F.lit(0)).orderBy("part")  # a row a partition
    sides = edge.select("part", F.lag("last").over(w).alias("before"), F.lead("first").over(w).alias("behind")).select(
        "part", F.explode(F.array(F.struct(F.col("before").alias("key"), F.lit(-1).alias("side")),
                                  F.struct(F.col("behind").alias("key"), F.lit(1).alias("side")))).alias("s")).select(
        "part", "s.*")
    both = cells.withColumn("side", F.lit(0)).unionByName(sides.filter("key IS NOT NULL"), allowMissingColumns=True)
    return written(both.groupBy("part").applyInArrow(_grow(depth), NODE), "trie-nodes")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and block -> a digest a node."""
    at, sha, out = None, None, []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                           pa.array([r[1] for r in rows], pa.string())], ["id", "ends_sha256"])
    for b in batches:
        for node, ids in zip(b.column("id").to_pylist(), b.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    out.append((at, sha.hexdigest()))
                at, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if len(out) > 10_000:
            yield batch(out)
            out = []
    if at is not None:
        yield batch([*out, (at, sha.hexdigest())])


def conversation_trie(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, from all (conv_id) and their turns (conv_id, pos, unit)."""
    cut = turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / segment).cast("int").alias("level")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "unit"))).alias("t"))  # ``segment`` turns at most
    cut = cut.select("conv_id", "level", F.unhex(F.array_join("t.unit", "")).alias("units"))
    bare = convs.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    segments = written(cut.unionByName(bare.select("conv_id", F.lit(0).alias("level"), F.lit(b"").alias("units"))),
                       "trie-segments")
    deepest = segments.agg(F.max("level")).first()[0] or 0
    whole = F.unhex(F.md5("key"))
    # down: strings of each level, headed by the id of all turns before
    strings = [segments.filter("level = 0").select("conv_id", F.concat(F.lit(bytes(UNIT)), "units").alias("key"))]
    for level in range(1, deepest + 1):
        head = strings[-1].select("conv_id", F.concat(whole, F.lit(bytes(UNIT - 16))).alias("head"))
        strings.append(written(segments.filter(F.col("level") == level).join(head, "conv_id").select(
            "conv_id", F.concat("head", "units").alias("key")), "trie-level"))
    # up: forests, each with the totals of what hangs on its full segments
    levels, hanging = [], None
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    for level in range(deepest, -1, -1):
        s = strings[level].groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
        s = s.withColumn("id", whole)
        s = s.join(hanging, "id", "left") if hanging is not None else s.withColumns(
            {c: F.lit(0).cast("bigint") for c in ("n_children", "n_leaves", "saved_tokens")})
        nodes = _forests(s.fillna(0, ["n_children", "n_leaves", "saved_tokens"]).drop("id"), level * segment)
        hanging = nodes.filter("units = 1").groupBy("id").agg(*sums)
        levels.append(nodes.filter("units > 1") if level else nodes)
    parts = levels[0]
    for x in levels[1:]:
        parts = parts.unionByName(x)
    merged = parts.filter("open").groupBy("id", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *sums,
        F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(True).alias("open"), F.lit(True).alias("parent_open"))
    nodes = parts.filter("NOT open").drop("units").unionByName(merged)
    # only nodes on a border of a partition or a segment can be parents that were not known there
    border = nodes.filter(F.col("open") | (F.col("depth") % segment == 0)).select(
        F.col("id").alias("parent"), F.col("conv_id").alias("p"))
    nodes = nodes.filter("NOT parent_open").unionByName(
        nodes.filter("parent_open").join(border, "parent", "left").withColumn("parent_conv_id", F.col("p")).drop("p"))
    last = [s.join(strings[i + 1], "conv_id", "left_anti") if i < deepest else s for i, s in enumerate(strings)]
    ends = last[0]
    for x in last[1:]:
        ends = ends.unionByName(x)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.select(F.when(F.length("key") == UNIT, F.substring("key", 1, 16)).otherwise(whole).alias("id"),
                         "conv_id", F.floor(F.col("conv_id") / BLOCK).alias("block")).groupBy("id", "block").agg(
        F.array_join(ids, ",").alias("ids"))
    digests = pieces.repartition("id").sortWithinPartitions("id", "block").mapInArrow(
        _digests, "id binary, ends_sha256 string")
    return nodes.join(digests, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(turns_of(table(spark, sf_dir, "conversations")), "trie-turns")
    return conversation_trie(*rebuilt(turns))


QUERIES = {"op11_conversation_trie": op11_conversation_trie}

# crc32 by its byte table, which is made from the polynomial
ORACLE = {"op11_conversation_trie": r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
o AS (SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
      FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, m) AS own FROM o GROUP BY conv_id),
h AS (SELECT l.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''),
        lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h FROM l, crc),
s AS (SELECT h.conv_id, list_concat(coalesce(d.own[1:h.h], []), h.own[h.h + 1:]) AS s
      FROM h LEFT JOIN l d ON d.conv_id = h.conv_id - ((h.conv_id % 20) + 20) % 20),
m AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s),
n AS (SELECT s[1:d] AS path, d, min(conv_id) AS conv_id, count(*) AS n,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '')) AS ends
      FROM m GROUP BY ALL),
k AS (SELECT path[1:d - 1] AS path, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(kids, 0) AS kids, CASE WHEN d > 0 THEN
        (n.n - 1) * len(regexp_extract_all(n.path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS own
      FROM n LEFT JOIN k ON k.path = n.path),
a AS (SELECT unnest(list_transform(range(0, d + 1), lambda i: path[1:i])) AS path, (kids = 0)::INT AS leaf, own FROM v),
t AS (SELECT path, sum(leaf) AS leaves, sum(own) AS saved FROM a GROUP BY path)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.kids AS n_children,
  t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN t ON t.path = v.path LEFT JOIN n p ON v.d > 0 AND p.path = v.path[1:v.d - 1] AND p.d = v.d - 1"""}
