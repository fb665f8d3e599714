"""Merkle manifest of a table: a digest for each row, joined 16 at a time up to one root, and proofs from it.

Each source is a tree over its rows in order of their ids, and the sources' roots are the leaves of one more tree. Only
every `STRIDE` levels are stored: a stored row is an aligned subtree, with the digests of its up to
16 ** STRIDE lowest nodes, and its top is a lowest node of the subtree above. A proof is made from the stored
levels down: a task that has a subtree works out the levels between anew, emits what stands beside each of
its lowest nodes, and forgets them.

Rows get their places without ever meeting in one task: they are dealt out in ranges of (tree, order), numbered within
each range, and a small table of the ranges' lengths by tree tells where each range begins. After that a subtree is a
group of bounded size, whatever share of the rows a source has.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import lower_ascii, picked, ship, small_enough, written

FAN = 16
STRIDE = 2
BROADCAST_BYTES = 32 * 1024 * 1024
# The columns that make up a leaf, in order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")

# A step of a proof: the digests that stand before and after the node in its run.
_PATH = "array<struct<before: string, after: string>>"
_PATH_SCHEMA = f"tree string, place long, path {_PATH}"


def _part(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(_part, (doc_id, source, lang, n_chars, text))), 256)


# --- places


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with `place`, their number within `tree` (a text, never null) by `order`, and `nodes`, the tree's
    number of rows. Rows equal in all of these are in any order; they are dealt out like others."""
    own = written(rows.withColumn("_spread", F.monotonically_increasing_id()), "unplaced")
    keys = [tree, *order, "_spread"]
    ranged = written(
        own.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_spread"),
        "ranged",
    )
    # The upper bits of the number tell the range, the lower bits count on within it.
    ranged = ranged.withColumn("_range", F.shiftright("_row", 33))
    lengths = ranged.groupBy(tree, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(tree).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select(
        tree,
        "_range",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(tree)).alias("nodes"),
    )
    starts = small_enough(written(starts, "starts"), 64 + F.octet_length(tree), BROADCAST_BYTES)
    shifted = ranged.join(starts, [tree, "_range"])
    return shifted.withColumn("place", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift")


# --- digests within a subtree


def _runs(digests: list[str]) -> list[list[str]]:
    return [digests[i : i + FAN] for i in range(0, len(digests), FAN)]


def _hash(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _levels(digests: list[str], nodes: int, stride: int) -> list[list[str]]:
    """The levels of a subtree from its lowest nodes up, in a tree that has `nodes` on the lowest level: it ends early
    where the tree has come down to one node."""
    levels = [digests]
    for _ in range(stride):
        if nodes == 1:
            break
        levels.append([_hash(run) for run in _runs(levels[-1])])
        nodes = -(-nodes // FAN)
    return levels


def _steps(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """What stands before and after a lowest node and those above it, level by level, below the top."""
    steps = []
    for level in levels[:-1]:
        start = place - place % FAN
        run = level[start : start + FAN]
        steps.append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
        place //= FAN
    return steps


def _tops(stride: int):
    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """tree, place, nodes, digest: the subtrees' tops as lowest nodes of the next stored level."""
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "nodes", "digests")), strict=True)
            for tree, block, nodes, digests in rows:
                levels = _levels(digests, nodes, stride)
                above = nodes
                for _ in levels[1:]:
                    above = -(-above // FAN)
                out.append((tree, block, above, levels[-1][0]))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string()),
                ],
                names=["tree", "place", "nodes", "digest"],
            )

    return top


def _proofs(stride: int):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """tree, place, path: of each lowest node, its steps within the subtree and those of the subtree's top."""
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "nodes", "digests", "path")), strict=True)
            for tree, block, nodes, digests, path in rows:
                levels = _levels(digests, nodes, stride)
                paths = [
                    [{"before": b, "after": a} for b, a in _steps(levels, i)] + (path or []) for i in range(len(digests))
                ]
                first = block * FAN**stride
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * len(digests), pa.string()),
                        pa.array(range(first, first + len(digests)), pa.int64()),
                        pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                    ],
                    names=["tree", "place", "path"],
                )

    return prove


def _verdicts(stride: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """tree, doc_id, leaf, proof_sha256, folded_root: of each row of a subtree, by its whole proof."""
        for batch in batches:
            columns = ("tree", "nodes", "digests", "shown", "path")
            rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            for i, (tree, nodes, digests, shown, path) in enumerate(rows):
                levels = _levels(digests, nodes, stride)
                above = [(step["before"], step["after"]) for step in path or []]
                proofs, folds = [], []
                for place, node in enumerate(shown):
                    steps = _steps(levels, place) + above
                    proofs.append(sha256("".join(b + a for b, a in steps).encode()).hexdigest())
                    for before, after in steps:
                        node = sha256(f"{before}{node}{after}".encode()).hexdigest()
                    folds.append(node)
                ids = batch.column("ids")[i].values
                texts = [pa.array(x, pa.string()) for x in ([tree] * len(digests), digests, proofs, folds)]
                yield pa.RecordBatch.from_arrays(
                    [texts[0], ids, *texts[1:]], names=["tree", "doc_id", "leaf", "proof_sha256", "folded_root"]
                )

    return judge


# --- stored levels


def _subtrees(nodes: DataFrame, stride: int, **carried: str) -> DataFrame:
    """tree, block, nodes, digests and the columns carried along, as arrays in order: the aligned subtrees over `place`,
    which are groups of at most 16 ** stride rows."""
    row = F.struct("place", "digest", *[F.col(c).alias(name) for name, c in carried.items()])
    block = F.floor(F.col("place") / F.lit(FAN**stride)).cast("bigint").alias("block")
    grouped = nodes.groupBy("tree", block).agg(
        F.first("nodes").alias("nodes"), F.sort_array(F.collect_list(row)).alias("rows")
    )
    return grouped.select("tree", "block", "nodes", "rows.digest", *[f"rows.{c}" for c in carried]).withColumnRenamed(
        "digest", "digests"
    )


def manifest(nodes: DataFrame, stride: int, name: str, **carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees over nodes (tree, place, nodes, digest), lowest first, and their roots (tree,
    digest). Each level is written; the next one has a row for each of its subtrees."""
    levels, roots = [], None
    while True:
        stored = written(_subtrees(nodes, stride, **(carried if not levels else {})), f"{name}-{len(levels)}")
        levels.append(stored)
        tops = stored.mapInArrow(_tops(stride), "tree string, place long, nodes long, digest string")
        nodes = written(tops, f"{name}-tops")
        done = nodes.where("nodes = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionAll(done)
        nodes = nodes.where("nodes > 1")
        if nodes.isEmpty():
            return levels, roots


def _with_path(level: DataFrame, paths: DataFrame, ended: DataFrame, stride: int) -> DataFrame:
    """A stored level's subtrees with the path of their tops: from the level above, or `ended` for a whole tree."""
    above = paths.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "path")
    whole = ended.select(F.col("tree").alias("_tree"), F.lit(-1).cast("bigint").alias("_place"), "path")
    wanted = F.when(F.col("nodes") > FAN**stride, F.col("block")).otherwise(F.lit(-1))
    return level.join(
        above.unionAll(whole), (F.col("tree") == F.col("_tree")) & (wanted == F.col("_place")), "left"
    ).drop("_tree", "_place")


def paths_above(levels: list[DataFrame], ended: DataFrame, stride: int, name: str) -> DataFrame:
    """tree, place, path: of the tops of the lowest stored level, for trees of more than one such. `ended` has the path
    (tree, path) of each tree's root."""
    paths = ended.select("tree", F.lit(0).cast("bigint").alias("place"), "path").limit(0)
    for k in range(len(levels) - 1, 0, -1):
        within = _with_path(levels[k], paths, ended, stride)
        paths = written(within.mapInArrow(_proofs(stride), _PATH_SCHEMA), f"{name}-{k}")
    return paths


def verified(
    docs: DataFrame,
    tampered: Column | None = None,
    stride: int = STRIDE,
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    `docs` has the columns doc_id, source, lang, n_chars and text, whose values, nulls included, make up a leaf; further
    columns take no part. Sources come in bytewise order, null first, and are told from an empty name. Within a source,
    rows are in order of doc_id, null first, then of their leaves; rows equal in all columns take places
    next to each other and have proofs of their own. `tampered` says which rows are shown with their text's A-Z
    lower-cased; their `folded_root` is worked out from that and the siblings of the untampered table. Null counts as
    not tampered. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    plain = picked(docs, **{c: c for c in LEAF[:-1]}, text=text_col)
    columns = [F.col(c) for c in LEAF]
    shown = leaf(*columns[:-1], F.when(F.col("text").isNotNull(), lower_ascii(F.col("text"))))
    true = leaf(*columns)
    rows = plain.select(
        "doc_id",
        # Null sorts before all names, and is a tree like them.
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        true.alias("digest"),
        (true if tampered is None else F.when(tampered, shown).otherwise(true)).alias("shown"),
    )
    numbered = placed(rows, "tree", ["doc_id", "digest"])
    levels, subroots = manifest(numbered, stride, "rows", ids="doc_id", shown="shown")
    subroots = written(subroots, "subroots")

    sources = subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("own"))
    top_levels, top = manifest(placed(sources, "tree", ["own"]), stride, "sources", own="own")
    found = top.head()
    root = F.lit(found["digest"] if found else None).cast("string")
    nothing = top.select("tree", F.lit(None).cast(_PATH).alias("path"))
    above = paths_above(top_levels, nothing, stride, "sources-paths")
    steps = _with_path(top_levels[0], above, nothing, stride).mapInArrow(_proofs(stride), _PATH_SCHEMA)
    at = (F.col("block") * FAN**stride + F.col("at")).alias("place")
    names = top_levels[0].select("block", F.posexplode("own").alias("at", "own")).select(at, "own")
    ended = written(names.join(steps, "place").select(F.col("own").alias("tree"), "path"), "sources-proofs")

    paths = paths_above(levels, ended, stride, "rows-paths")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    judged = _with_path(levels[0], paths, ended, stride).mapInArrow(
        _verdicts(stride), f"tree string, doc_id {id_type}, leaf string, proof_sha256 string, folded_root string"
    )
    subroots = subroots.select("tree", F.col("digest").alias("subroot"))
    subroots = small_enough(subroots, 128 + F.octet_length("tree"), BROADCAST_BYTES)
    return judged.join(subroots, "tree").select(
        "doc_id",
        F.expr("if(tree = '', null, substring(tree, 2))").alias("source"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
