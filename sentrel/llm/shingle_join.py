"""Jaccard join of word-shingle sets, filtered under several global token orders.

If two sets reach the similarity, they share a token among the first few of each, under any order of
all tokens that both follow; so a pair that misses under one order is no candidate. The orders used
here are, one after the other, a hash order, rare tokens first, and a second hash order.

1. Hash order: the lowest hashes of a set are a random sample of it. A set of a linked pair shares
   at least three quarters of its tokens, so sets whose samples hold far fewer tokens that any
   other set also holds drop out. Only samples of a fixed size are shuffled.
2. The sets that stay are gathered whole. Under the order "rare tokens first", with exact counts
   among them, prefixes are matched and sets that share prefix tokens form clusters.
3. Under a second hash order, each cluster is cut into the parts that share prefix tokens there.
4. Inside a part, blocks of sets are compared exactly, two blocks at a time. Links are held for
   one tile of two blocks only, then folded into a spanning forest, which distributed components
   join.

Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.llm import shingles
from sentrel.llm.components import components, forest
from sentrel.llm.stages import Stages, bitmap, sorted_groups


#: Counts of tokens are told apart up to here, in the bits above so many bits of hash.
MANY = 2047
HASH_BITS = 52


@dataclass(frozen=True)
class Settings:
    """``percent`` is the similarity; ``deviations`` sets how surely a sample keeps linked sets.

    At 8 deviations a set of a linked pair is lost with a probability below 1e-11; sets of up to
    48 shingles are tested whole. ``document_bits`` bounds the bitmap of candidates that is
    broadcast; a full one only lets more documents through to an exact join. A block holds about
    ``block_tokens`` tokens and ``block_rows`` sets at most.
    """

    width: int = 5
    percent: int = 75
    sample: int = 64
    deviations: float = 8.0
    document_bits: int = 1 << 23
    block_tokens: int = 1 << 17
    block_rows: int = 1 << 13


def _top(share: float) -> int:
    return min(int(share * 2.0**64), 2**64 - 1)


def sample_sizes(tokens: np.ndarray, settings: Settings) -> tuple[int, int]:
    """How many of a set's lowest hashes it publishes, and how many of those it counts.

    A set counts at a rate that every set it can link with publishes at.
    """
    n, ratio = len(tokens), settings.percent / 100
    cut = [
        n if settings.sample >= size else int(np.searchsorted(tokens, np.uint64(_top(settings.sample / size))))
        for size in (ratio * n, n / ratio)
    ]
    return max(cut), cut[1]


def least_shared(counted: int, n: int, settings: Settings) -> int:
    """Tokens of a sample that a linked set must share; exact if the sample is the whole set."""
    ratio = settings.percent / 100
    if counted == n:
        return -(-settings.percent * n // 100)
    return max(1, int(ratio * counted - settings.deviations * np.sqrt(ratio * (1 - ratio) * counted)))


def digest() -> Column:
    """Tells apart the texts of rows that share a ``doc_id``."""
    return F.xxhash64("text")


def _node(tokens: np.ndarray) -> int:
    """Name of a set: a hash of its sorted tokens."""
    factors = shingles.mix(np.arange(1, len(tokens) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        total = (shingles.mix(tokens ^ factors)).sum(dtype=np.uint64) + np.uint64(len(tokens))
        return int(shingles.mix(np.array([total]))[0].astype(np.int64))


def _signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, digest, n, node, counted, least, sample``; a task publishes each distinct set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, nodes, counts, least, samples = [], [], [], [], []
            for tokens in shingles.sets(batch.column("text"), settings.width):
                sizes.append(len(tokens))
                if not len(tokens):
                    nodes.append(None)
                    counts.append(0)
                    least.append(0)
                    samples.append(None)
                    continue
                node = _node(tokens)
                published, counted = sample_sizes(tokens, settings)
                nodes.append(node)
                counts.append(counted)
                least.append(least_shared(counted, len(tokens), settings))
                samples.append(None if node in seen else tokens[:published].view(np.int64))
                seen.add(node)
            if len(seen) > 1 << 18:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(counts, pa.int32()), pa.array(least, pa.int32()),
                 pa.array(samples, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "n", "node", "counted", "least", "sample"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest().alias("digest")).mapInArrow(
        run, "doc_id long, digest long, n long, node long, counted int, least int, sample array<long>"
    )


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, shared`` from rows ``h, node, counts`` sorted by ``h, node``: how many counting rows
    of a node have an ``h`` that another node has too. Holds one batch, however long a run of ``h`` is.
    """
    last_h = last_node = None
    mixed, pending = False, 0
    for batch in batches:
        if not len(batch):
            continue
        h, node = batch.column("h").to_numpy(), batch.column("node").to_numpy()
        counts = batch.column("counts").to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        several = np.minimum.reduceat(node, begin) != np.maximum.reduceat(node, begin)
        extra: list[tuple[int, int]] = []
        if last_h is not None and h[0] == last_h:
            if mixed or node[0] != last_node or several[0]:
                several[0] = True
                if not mixed and pending:
                    extra.append((last_node, pending))
                pending = 0
        else:
            pending = 0
        run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
        chosen = several[run] & counts
        names, found = np.unique(node[chosen], return_counts=True)
        if not several[-1]:
            own = run == len(begin) - 1
            pending = int(counts[own].sum()) + (pending if len(begin) == 1 else 0)
        else:
            pending = 0
        last_h, last_node, mixed = h[-1], node[-1], bool(several[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names.tolist() + [int(x) for x, _ in extra], pa.int64()),
             pa.array(found.tolist() + [x for _, x in extra], pa.int64())],
            names=["node", "shared"],
        )


def _candidates(signed: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """All nodes with their smallest document, and the ones whose sample is shared enough."""
    nodes = stages.write(
        signed.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.first("n").alias("n"), F.first("least").alias("least"), F.min("doc_id").alias("doc_id"),
        )
    )
    postings = signed.select(
        "node", "counted", F.posexplode("sample").alias("place", "h")
    ).select("h", "node", (F.col("place") < F.col("counted")).alias("counts"))
    shared = (
        postings.repartition("h").sortWithinPartitions("h", "node")
        .mapInArrow(shared_runs, "node long, shared long")
        .groupBy("node").agg(F.sum("shared").alias("shared"))
    )
    # A task that published a set twice counts it twice; that only lets more through.
    kept = nodes.join(shared, "node").where(F.col("shared") >= F.col("least"))
    return nodes, stages.write(kept.select("node", "n", "doc_id"))


def _whole_sets(docs: DataFrame, candidates: DataFrame, settings: Settings, stages: Stages) -> DataFrame:
    """``node, n, tokens`` of every candidate, from the text of its smallest document."""
    spark = docs.sparkSession
    bits = settings.document_bits
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    wanted = spark.sparkContext.broadcast(bitmap(candidates, place, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            at = batch.column("place").to_numpy()
            rows = batch.filter(pa.array((held[at >> 3] >> (at & 7)) & 1 == 1))
            nodes, tokens = [], []
            for found in shingles.sets(rows.column("text"), settings.width):
                nodes.append(_node(found) if len(found) else None)
                tokens.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))],
                names=["doc_id", "node", "tokens"],
            )

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("place", place).mapInArrow(
        run, "doc_id long, node long, tokens array<long>"
    )
    # Candidates grow with the corpus: whole sets meet them by key at every size.
    rows = candidates.withColumnsRenamed({"node": "__node", "doc_id": "__doc"}).hint("merge")
    exact = found.join(
        rows, (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    )
    return stages.write(
        exact.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    )


def counted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, key`` from rows ``h, node`` sorted by ``h``, for every ``h`` of two rows or more.

    The key orders tokens: how many rows hold the token, up to ``MANY``, in the upper bits, and
    its hash in the lower ones. Holds one batch and at most ``MANY`` rows of a run.
    """
    held_h = np.zeros(0, dtype=np.int64)
    held_node = np.zeros(0, dtype=np.int64)
    crowded = None

    def emit(h: np.ndarray, node: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        low = h.view(np.uint64) >> np.uint64(64 - HASH_BITS)
        key = (many.astype(np.uint64) << np.uint64(HASH_BITS)) | low
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(key.view(np.int64))], names=["node", "key"])

    for batch in batches:
        h = np.concatenate((held_h, batch.column("h").to_numpy()))
        node = np.concatenate((held_node, batch.column("node").to_numpy()))
        if not len(h):
            continue
        begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        sizes = np.diff(np.append(begin, len(h)))
        many = np.minimum(sizes, MANY)
        if crowded is not None and h[0] == crowded:
            many[0] = MANY
        # The last run may go on in the next batch; a crowded one needs no more counting.
        last = begin[-1]
        if many[-1] == MANY:
            crowded, last = h[-1], len(h)
        run = np.repeat(many, sizes)[:last]
        chosen = run > 1
        yield emit(h[:last][chosen], node[:last][chosen], run[chosen])
        held_h, held_node = h[last:], node[last:]
    if len(held_h) > 1:
        yield emit(held_h, held_node, np.full(len(held_h), len(held_h)))


def _clusters(whole: DataFrame, settings: Settings, stages: Stages) -> DataFrame:
    """``node, cluster``: sets that may link share a cluster under both orders."""
    shared = (
        whole.select("node", F.explode("tokens").alias("h"))
        .repartition("h").sortWithinPartitions("h").mapInArrow(counted_runs, "node long, key long")
        .groupBy("node").agg(F.collect_list("key").alias("held"))
    )
    least = F.ceil(F.col("n") * settings.percent / F.lit(100))
    # Tokens that no other candidate holds come first in both orders and match nothing.
    prefix = F.col("n") - least + 1 - (F.col("n") - F.size("held"))
    held = shared.join(whole.select("node", "n"), "node").withColumn("prefix", prefix.cast("int"))
    by_hash = F.sort_array(F.transform("held", lambda x: F.struct(F.xxhash64(x).alias("order"), x.alias("key"))))
    held = stages.write(
        held.where(F.col("prefix") > 0).select(
            "node", F.slice(F.sort_array("held"), F.lit(1), F.col("prefix")).alias("rare"),
            F.slice(by_hash, F.lit(1), F.col("prefix"))["key"].alias("hashed"),
        )
    )
    stages.release()
    cluster = None
    for order in ("rare", "hashed"):
        rows = held.select("node", F.explode(order).alias("h"))
        keys = ["h"]
        if cluster is not None:
            rows, keys = rows.join(cluster, "node"), ["h", "cluster"]
        rows = stages.write(rows)
        heads = stages.write(
            rows.groupBy(*keys).agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("many"))
            .where(F.col("many") > 1).drop("many")
        )
        found = components(
            rows.join(heads, keys).where(F.col("node") != F.col("head"))
            .select(F.col("node").alias("u"), F.col("head").alias("v")).distinct(), stages,
        )
        stages.drop(rows, heads)
        cluster = stages.write(found.select("node", F.col("component").alias("cluster")))
    return cluster


def intersections(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``first`` with every set of ``second``."""
    names, index, many = np.unique(np.concatenate(first + second), return_inverse=True, return_counts=True)
    column = np.where(many > 1, np.cumsum(many > 1) - 1, -1)[index]
    rows = np.repeat(np.arange(len(first) + len(second)), [len(x) for x in first + second])
    keep = column >= 0
    column, rows = column[keep], rows[keep]
    order = np.argsort(column, kind="stable")
    column, rows = column[order], rows[order]
    out = np.zeros((len(first), len(second)), dtype=np.float32)
    for start in range(0, int((many > 1).sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        width = min(4096, int((many > 1).sum()) - start)
        held = np.zeros((len(first) + len(second), width), dtype=np.float32)
        held[rows[a:b], column[a:b] - start] = 1
        out += held[: len(first)] @ held[len(first) :].T
    return out.astype(np.int64)


def spanning(
    nodes: np.ndarray, tokens: list[np.ndarray], first: np.ndarray, second: np.ndarray, percent: int, step: int = 512
) -> np.ndarray:
    """Smallest node that links between the places ``first`` and ``second`` reach, for every place.

    Holds the links of one tile. A tile whose sets are all connected already is not compared.
    """
    order = np.argsort(nodes)
    sizes = np.array([len(x) for x in tokens], dtype=np.int64)
    heads = np.arange(len(nodes))
    same = np.array_equal(first, second)
    for i in range(0, len(first), step):
        for j in range(i if same else 0, len(second), step):
            x, y = first[i : i + step], second[j : j + step]
            if (heads[x] == heads[x[0]]).all() and (heads[y] == heads[x[0]]).all():
                continue
            both = intersections([tokens[k] for k in x], [tokens[k] for k in y])
            union = sizes[x][:, None] + sizes[y][None, :] - both
            a, b = np.nonzero(100 * both >= percent * union)
            a, b = heads[x[a]], heads[y[b]]
            apart = a != b
            if apart.any():
                best = forest(a[apart], b[apart], nodes)
                heads = order[np.searchsorted(nodes, best[heads], sorter=order)]
    return nodes[heads]


def _links(whole: DataFrame, cluster: DataFrame, settings: Settings, stages: Stages) -> DataFrame:
    """``u, v``: a spanning forest of the links inside every pair of blocks."""
    members = stages.write(whole.join(cluster.hint("merge"), "node"))
    stages.release()
    sizes = stages.write(
        members.groupBy("cluster").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("size") > settings.block_tokens) | (F.col("rows") > settings.block_rows))
    )
    by_size = F.greatest(F.col("size") / settings.block_tokens, F.col("rows") / settings.block_rows)
    parts = F.coalesce(F.ceil(by_size), F.lit(1)).cast("int")
    blocked = (
        members.join(sizes, "cluster", "left").withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                "own", "node", "tokens")
    )

    def compare(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(group) < 2:
            return
        _, low, high = key
        nodes = group.column("node").to_numpy()
        own = group.column("own").to_numpy()
        lists = group.column("tokens").combine_chunks()
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        tokens = [flat[a:b] for a, b in zip(ends, ends[1:])]
        roots = spanning(nodes, tokens, np.flatnonzero(own == low), np.flatnonzero(own == high), settings.percent)
        some = np.flatnonzero(roots != nodes)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(roots[some])], names=["u", "v"])

    return sorted_groups(blocked, ["cluster", "low", "high"], compare, "u long, v long")


def grouped(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, digest, n_shingles, component_id, component`` of every row.

    The component names the texts that links connect, with ``doc_id`` or without; null for texts
    without shingles, which link with nothing.
    """
    stages = Stages(docs.sparkSession, "shingle-join")
    signed = stages.write(_signatures(docs, settings))
    nodes, candidates = _candidates(signed, stages)
    rows = stages.write(signed.select("doc_id", "digest", "n", "node"))
    stages.drop(signed)
    stages.release()
    whole = _whole_sets(docs, candidates, settings, stages)
    stages.release()
    cluster = _clusters(whole, settings, stages)
    links = stages.write(_links(whole, cluster, settings, stages))
    stages.drop(whole)
    stages.release()
    found = stages.write(components(links, stages))
    smallest = stages.write(
        found.join(nodes, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    by_node = stages.write(
        nodes.join(found.join(smallest, "component"), "node", "left").select(
            "node", F.coalesce("component", "node").alias("component"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    )
    return rows.join(by_node, "node", "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two texts link when their sets of five-word shingles have a Jaccard similarity of 0.75 or
    more; the component is the smallest ``doc_id`` that links reach, the row's own included.
    Texts with fewer than five words are one shingle; null texts and texts without words have
    none and link with nothing. Rows without ``doc_id`` link as any other but lend no id: a
    component of such rows alone is null. Rows that share a ``doc_id`` are separate texts. Other
    columns are not read.
    """
    return grouped(docs, settings).select("doc_id", "n_shingles", "component_id")
