"""A Merkle manifest of a dataset: trees of digests, an append log of their nodes, proofs of single rows.

Every row is a leaf: the digest of its fields. The leaves of a tree (documents of one language) ascend by a
key; runs of eight neighbours become their parent, level by level, a last short run too. The roots of all
trees, in the order of their names, are the leaves of one more tree, whose root stands for the dataset.

The log holds nodes in postorder, that is in the order in which appending leaves completes them. It is
written by aligned builders: builder b of a height of 4 takes the leaves [4096 b, 4096 (b + 1)) of a tree and
writes its nodes as they are completed; its top node is a leaf of the builders above. Where a node lies
follows from its level, its number and the count of leaves alone (`position`), so a proof addresses its
siblings in the log without a search: those below the builder's top in its own row, those above in the rows
of the builders above, which all rows of the builder share.

No group is larger than 4,096 rows, whatever share of the rows a tree holds. Texts are hashed where they
are read and never shuffled.

Cases: a null field is `-` in the digest and a null key comes first; a null tree name is a tree of its own, the
first. Empty and very long texts are fields like others. Rows of equal keys are in the order of their digests;
repeated rows are leaves of their own, with proofs of their own. An empty table has no tree and gives no rows.
Columns beside those named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabpulse.llm.checksums import CRC_TABLE, crc_sql
from fabpulse.llm.scratch import stored

FANOUT = 8
HEIGHT = 4  # of a builder, which thus has 4,096 leaves

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<slot int, siblings array<binary>>>"
_PATH_TYPE = pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.list_(pa.binary()))]))
Path = list[dict]


# --- One builder -----------------------------------------------------------------------


def digest(run: Sequence[bytes]) -> bytes:
    """The digest of digests, which are concatenated as hex text."""
    return hashlib.sha256("".join(map(bytes.hex, run)).encode()).digest()


def levels_of(leaves: int) -> int:
    """Levels above the leaves until one node is left; none above a lone leaf."""
    levels = 0
    while FANOUT ** levels < leaves:
        levels += 1
    return levels


def position(level: int, number: int, leaves: int, levels: int) -> int:
    """Where a node lies in the postorder log of a tree.

    Before it come, up to its own level, all nodes that end with its last leaf or earlier, and of the levels
    above only those that were complete without that leaf.
    """
    last = min((number + 1) * FANOUT ** level, leaves)
    ended = sum(-(-last // FANOUT ** m) for m in range(level + 1))
    return ended + sum((last - 1) // FANOUT ** m for m in range(level + 1, levels + 1)) - 1


def append_log(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """The nodes over some leaves in the order in which appending completes them; the last is the root."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def write(node: bytes, level: int) -> None:
        log.append(node)
        waiting[level].append(node)
        if level < levels and len(waiting[level]) == FANOUT:
            close(level)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        write(digest(run), level + 1)

    for leaf in leaves:
        write(leaf, 0)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def run_siblings(log: Sequence[bytes], leaves: int, levels: int) -> list[list[list[bytes]]]:
    """Per level below the top, the runs of that level's nodes, read from the log by position."""
    found = []
    for level in range(levels):
        count = -(-leaves // FANOUT ** level)
        nodes = [log[position(level, number, leaves, levels)] for number in range(count)]
        found.append([nodes[low:low + FANOUT] for low in range(0, count, FANOUT)])
    return found


def path_of(runs: list[list[list[bytes]]], leaf: int) -> Path:
    """The place of a leaf in its run and the others of the run, level by level."""
    path = []
    for level in runs:
        leaf, slot = divmod(leaf, FANOUT)
        run = level[leaf]
        path.append({"slot": slot, "siblings": run[:slot] + run[slot + 1:]})
    return path


def fold(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for step in path:
        others, slot = step["siblings"], step["slot"]
        leaf = digest([*others[:slot], leaf, *others[slot:]])
    return leaf


# --- Leaves and their order ------------------------------------------------------------


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of fields: each `-` if null, else its length in bytes, a colon and its value."""
    texts = [field.cast("string") for field in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256))


def _tree_name(tree: Column) -> Column:
    """A name that is never null and sorts as the trees do."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `place`, gapless from 0 in each `tree` by `order`, and `size`, the tree's count of rows.

    One range partitioning puts the rows of all trees in order, so a tree is cut wherever a partition is
    full. What precedes a partition is a sum over one row per tree and partition. Rows equal in all of
    `order` may be spread over partitions too: they differ by a mark only.
    """
    keys = ["tree", *order, "_mark"]
    parts = stored(
        rows.withColumn("_mark", F.monotonically_increasing_id())
        .repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "leaves")
    counts = parts.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    in_tree = Window.partitionBy("tree")
    before = in_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(in_tree).alias("size"))
    number = F.row_number().over(Window.partitionBy("_part", "tree").orderBy(*order, "_mark"))
    return (
        parts.withColumn("_number", number).join(starts, ["tree", "_part"])
        .withColumn("place", F.col("_start") + F.col("_number") - 1)
        .drop("_part", "_mark", "_number", "_start")
    )


# --- The log ---------------------------------------------------------------------------


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    order = sorted(zip(rows["place"].to_pylist(), rows["node"].to_pylist()))
    size, height = rows["size"][0].as_py(), rows["height"][0].as_py()
    levels = min(height, levels_of(size))
    log = append_log([node for _, node in order], levels)
    return pa.table({
        "tree": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int64()),
        "size": pa.array([size], pa.int64()), "leaves": pa.array([len(order)], pa.int32()),
        "levels": pa.array([levels], pa.int32()),
        "log": pa.array([b"".join(log)], pa.binary()), "top": pa.array([log[-1]], pa.binary()),
    })


_LOG = "tree string, block long, size long, leaves int, levels int, log binary, top binary"


def write_logs(nodes: DataFrame, height: int = HEIGHT) -> list[tuple[DataFrame, DataFrame]]:
    """Builders over builders, until each tree is one block: (nodes, log) of each height.

    `nodes` has `tree`, `place`, `size` and `node`. A log has one row per builder, its nodes in completion
    order. The number of heights grows with the logarithm, to the base 4,096, of the largest tree.
    """
    block = FANOUT ** height
    found = []
    while True:
        nodes = nodes.withColumns({"block": F.expr(f"place div {block}"), "leaf": F.col("place") % block})
        log = stored(
            nodes.select("tree", "block", "place", "size", "node", F.lit(height).alias("height"))
            .groupBy("tree", "block").applyInArrow(_build, _LOG)
            .withColumn("whole", F.col("size") <= block), "log")
        found.append((nodes, log))
        above = log.where("NOT whole")
        if above.isEmpty():
            return found
        nodes = above.select(
            "tree", F.col("block").alias("place"), F.expr(f"(size + {block - 1}) div {block}").alias("size"),
            F.col("top").alias("node"))


def tops(logs: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The root of every tree: (tree, node)."""
    ended = [log.where("whole").select("tree", F.col("top").alias("node")) for _, log in logs]
    found, *rest = ended
    for more in rest:
        found = found.unionByName(more)
    return found


# --- Proofs ----------------------------------------------------------------------------


def _open_log(builder: pa.Table) -> tuple[list[list[list[bytes]]], Path]:
    """The runs of a builder's nodes, and the path above its top node."""
    row = builder.to_pylist()[0]
    log = [row["log"][low:low + 32] for low in range(0, len(row["log"]), 32)]
    return run_siblings(log, row["leaves"], row["levels"]), row["path"]


def _paths(key: tuple, nodes: pa.Table, builder: pa.Table) -> pa.Table:
    runs, above = _open_log(builder)
    return pa.table({
        "tree": nodes["tree"], "block": nodes["place"],
        "path": pa.array([path_of(runs, leaf) + above for leaf in nodes["leaf"].to_pylist()], _PATH_TYPE),
    })


def _proofs(key: tuple, nodes: pa.Table, builder: pa.Table) -> pa.Table:
    found = _paths(key, nodes, builder)
    return nodes.drop(["block", "leaf"]).append_column("path", found["path"])


def _audits(key: tuple, nodes: pa.Table, builder: pa.Table) -> pa.Table:
    """Of each node the digest of its proof and the root it folds to, with `shown` in place of itself."""
    runs, above = _open_log(builder)
    upper = "".join(s.hex() for step in above for s in step["siblings"])
    digests, folded = [], []
    for leaf, node, shown in zip(*(nodes[c].to_pylist() for c in ("leaf", "node", "shown"))):
        path = path_of(runs, leaf)
        lower = "".join(s.hex() for step in path for s in step["siblings"])
        digests.append(hashlib.sha256((lower + upper).encode()).hexdigest())
        folded.append(fold(fold(node if shown is None else shown, path), above))
    return nodes.drop(["block", "leaf"]).append_column("proof_sha256", pa.array(digests, pa.string())) \
        .append_column("folded", pa.array(folded, pa.binary()))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def walk_down(logs: list[tuple[DataFrame, DataFrame]], above: DataFrame | None, last, added: str) -> DataFrame:
    """From the highest builders to the leaves, each node's path from its builder's log and the path above.

    `above` has the paths of trees, (tree, path), where a tree is itself a leaf of another. `last` answers
    for the leaves and adds the columns `added`.
    """
    paths = None
    for height in reversed(range(len(logs))):
        nodes, log = logs[height]
        ending = log.where("whole")
        if above is None:
            ending = ending.withColumn("path", F.array().cast(_PATH))
        else:
            ending = ending.join(above, "tree")
        if paths is not None:
            going = log.where("NOT whole").join(paths, ["tree", "block"])
            ending = ending.unionByName(going)
        builders = ending.select("tree", "block", "leaves", "levels", "log", "path")
        work, columns = (last, f"{_schema(nodes.drop('block', 'leaf'))}, {added}") if height == 0 else (
            _paths, f"tree string, block long, path {_PATH}")
        paths = nodes.groupBy("tree", "block").cogroup(builders.groupBy("tree", "block")) \
            .applyInArrow(work, columns)
    return paths


class Manifest:
    """The logs of all trees and of the tree over them."""

    def __init__(self, rows: DataFrame, tree: str, key: str, fields: Sequence[str] = FIELDS,
                 shown: Column | None = None, height: int = HEIGHT):
        """Write the logs of `rows`. `shown` is the digest a proof is tried with, the row's own where null."""
        leaves = rows.select(
            _tree_name(F.col(tree)).alias("tree"), F.col(key).alias("key"),
            leaf_digest([F.col(name) for name in fields]).alias("node"),
            (F.lit(None).cast("binary") if shown is None else shown).alias("shown"))
        # Written first: the range partitioning reads its input twice, and texts should be read once.
        self.trees = write_logs(numbered(stored(leaves, "digests"), ["key", "node", "shown"]), height)
        roots = tops(self.trees).withColumnRenamed("tree", "named").withColumn("tree", F.lit(""))
        self.over = write_logs(numbered(roots, ["named"]), height)

    def _above(self) -> DataFrame:
        """Of each tree the path from its root to that of the dataset."""
        found = walk_down(self.over, None, _proofs, f"path {_PATH}")
        return stored(found.select(F.col("named").alias("tree"), "node", "path"), "roots")

    def proofs(self) -> DataFrame:
        """Every row's key, digest and path: its place in each run and the run's other nodes."""
        above = self._above().select("tree", "path")
        return walk_down(self.trees, above, _proofs, f"path {_PATH}").select("tree", "key", "node", "path")

    def audits(self) -> DataFrame:
        """Every row's digest, those of its tree and the dataset, its proof's and the root it folds to."""
        above = self._above()
        root = tops(self.over).first()  # a single row, none without leaves
        found = walk_down(self.trees, above.select("tree", "path"), _audits,
                          "proof_sha256 string, folded binary")
        whole = F.lit(bytes(root["node"]) if root else None).cast("binary")
        return found.join(above.select("tree", F.col("node").alias("subroot")), "tree").withColumn("root", whole)


def tampered_leaf(fields: Sequence[str] = FIELDS) -> Column:
    """The digest of a row whose text was lower-cased, for every third checksum of an id; else null."""
    changed = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in fields]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest(changed))


def audit_documents(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest of documents by language, every proof tried with the text as tampered.

    A document without an id is not tampered with.
    """
    audits = Manifest(docs, "lang", "doc_id", shown=tampered_leaf(), height=height).audits()

    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    return audits.select(
        F.col("key").alias("doc_id"), text("node").alias("leaf"), text("subroot").alias("subroot"),
        text("root").alias("root"), "proof_sha256", text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


# --- The same in SQL -------------------------------------------------------------------

SQL_LEVELS = 8  # of each tree in the SQL, enough for 16 million documents a language


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR)::VARCHAR || ':' || ({column})::VARCHAR, '-')"


def _levels_sql(name: str, leaves: str) -> str:
    """Tables `name`0 to `name`8 of (tree, i, h): runs of eight become one, until one is left."""
    steps = [f"{name}0 AS ({leaves})"]
    for level in range(1, SQL_LEVELS + 1):
        steps.append(
            f"{name}{level} AS (SELECT tree, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h)"
            f" ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, any_value(n) > 1 AS made FROM"
            f" (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{level - 1}) GROUP BY tree, i // 8)")
    return ",\n".join(steps)


def _proof_sql(name: str, base: str) -> str:
    """Tables of (tree, p, q, s, f): per node p of `base`, level by level, its siblings and what it folds to."""
    steps = [f"{name}p0 AS ({base})"]
    for level in range(1, SQL_LEVELS + 1):
        below = f"{name}{level - 1}"
        steps.append(
            f"{name}p{level} AS (SELECT p.tree, p.p, any_value(p.q) // 8 AS q,"
            f" any_value(p.s) || coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i <> p.q), '') AS s,"
            f" CASE WHEN any_value(u.made) THEN sha256(string_agg(CASE WHEN b.i = p.q THEN p.f ELSE b.h END, ''"
            f" ORDER BY b.i)) ELSE any_value(p.f) END AS f FROM {name}p{level - 1} AS p"
            f" JOIN {below} AS b ON b.tree = p.tree AND b.i // 8 = p.q // 8"
            f" JOIN {name}{level} AS u ON u.tree = p.tree AND u.i = p.q // 8 GROUP BY p.tree, p.p)")
    return ",\n".join(steps)


def _oracle() -> str:
    whole = " || ".join(_field_sql(f) for f in FIELDS)
    changed = " || ".join(
        _field_sql(f"translate(text, '{_UPPER}', '{_LOWER}')" if f == "text" else f) for f in FIELDS)
    last = SQL_LEVELS
    return f"""WITH {CRC_TABLE},
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({whole}) AS h,
  CASE WHEN {crc_sql("doc_id::VARCHAR")} % 3 = 0 THEN sha256({changed}) END AS shown FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves),
{_levels_sql("a", "SELECT tree, i, h FROM placed")},
named AS (SELECT tree AS named, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM a{last}),
{_levels_sql("b", "SELECT '' AS tree, i, h FROM named")},
{_proof_sql("a", "SELECT tree, i AS p, i AS q, '' AS s, coalesce(shown, h) AS f FROM placed")},
{_proof_sql("b", "SELECT '' AS tree, l.tree || '/' || l.p AS p, n.i AS q, l.s, l.f"
            f" FROM ap{last} AS l JOIN named AS n ON n.named = l.tree")}
SELECT d.doc_id, d.h AS leaf, n.h AS subroot, r.h AS root, sha256(o.s) AS proof_sha256, o.f AS folded_root,
  o.f = r.h AS verified
FROM placed AS d JOIN named AS n ON n.named = d.tree JOIN bp{last} AS o ON o.p = d.tree || '/' || d.i, b{last} AS r"""


ORACLE = _oracle()
