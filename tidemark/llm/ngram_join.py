"""Joining documents whose word-shingle sets have a high Jaccard similarity, by adaptive multi-match prefixes.

Shingles have one global order, rare ones first, taken from a fixed-size table of hashed document
frequencies. If two sets are similar enough, their first ``l`` common shingles lie within the first
``size - least overlap + l`` shingles of each, so with a prefix longer by ``l - 1`` two documents must share
``l`` prefix shingles to be a candidate. Each document takes the ``l`` of least estimated cost; a pair must
share the smaller ``l`` of the two.

Documents with equal sets are one class, a node. A shingle shared by a large group of near copies would give
the square of the group in pairs; so each shingle's nodes are first compared with one of them, then those that
share a shingle of few nodes, as a copy and its own copies do. Crowded shingles come last; in the end, only nodes
of different components are paired. Shingles that the same nodes hold are paired once, with a weight. The pairs of a shingle's nodes are counted inside the tasks that hold two
chunks of them: a pair leaves the task of its first common shingle, if it shares enough. No link between
components is lost: every remaining pair of different components that shares enough prefix shingles is verified.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, key_groups, parts, slices, stage
from tidemark.llm.graph import connected_components
from tidemark.llm.text import Words, distinct_in_texts, shingles

#: Similarity as a fraction: 100 * intersection >= 80 * union.
PERCENT = 80
#: Longest prefix extension tried, and the cost of verifying a pair against reading a posting, per shingle.
MOST_MATCHES, VERIFY_COST = 6, 1 / 32
#: Counters of the frequency table (4 bytes each) and the ranges it is summed in.
COUNTERS, RANGES = 1 << 21, 128
#: Shingles of at least ``CROWD`` nodes are crowded. Their nodes are compared with one of them while their pairs exceed
#: all postings by the first factor, and a round leaves less than the second of the pairs. All pairs left are then
#: compared in any case.
CROWD = 32
PAIRS_PER_POSTING, WORTH_A_ROUND, STAR_ROUNDS = 0.5, 0.95, 8
#: Bits of the table that picks the texts to be compared.
FILTER_BITS = 1 << 24
#: Documents compared with one document in one run of a task.
COMPARED_AT_ONCE = 500
#: Nodes of a token in one chunk, and about how many of its node's other tokens a posting carries.
CHUNK, CARRIED = 1024, 256


def frequency_table(texts: DataFrame) -> np.ndarray:
    """Document frequencies of hashed shingles over all documents, ``COUNTERS`` of them, less their mean.

    A shingle's counter also holds others' counts; it only orders shingles and estimates costs, so results
    do not depend on it.
    """
    span = COUNTERS // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, "text"):
            values, _ = distinct_in_texts(*shingles(Words(batch.column("text"))))
            total += np.bincount((values & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        if total.any():
            packed = [zlib.compress(total[k * span : (k + 1) * span].astype("<u4").tobytes(), 1) for k in range(RANGES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array(packed, pa.binary())], ["span", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("span").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64)
        packed = [x.astype("<i8").tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(packed, pa.binary())], ["span", "counts"])

    schema = "span int, counts binary"
    rows = texts.select("text").mapInArrow(count, schema).repartition(min(RANGES, parts(texts)), "span").mapInArrow(add, schema).collect()
    table = np.zeros(COUNTERS, np.int64)
    for row in rows:  # COUNTERS values in all
        table[row.span * span : (row.span + 1) * span] = np.frombuffer(row.counts, "<i8")
    return np.minimum(np.maximum(0, table - int(table.mean())), 2**31 - 1).astype(np.int32)


def least_overlap(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of ``n`` shares with any set similar enough."""
    return -(-PERCENT * n // 100)


def prefixes(values: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's prefix shingles, rarest first, the prefixes' bounds, and the matches required, ``l``.

    Reading costs the postings of the prefix shingles. With ``l`` matches required at most their sum over
    ``l`` become candidates, each verified at a cost that grows with the set.
    """
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    frequency = table[(values & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.float64)
    order = np.lexsort((values, frequency, owner))
    values, frequency = values[order], frequency[order]
    sums = np.concatenate([[0.0], np.cumsum(frequency)])
    spare = n - least_overlap(n)
    best, cost = np.ones(len(n), np.int64), np.full(len(n), np.inf)
    for match in range(1, MOST_MATCHES + 1):
        length = np.minimum(spare + match, n)
        postings = sums[bounds[:-1] + length] - sums[bounds[:-1]]
        this = postings * (1 + (1 + n * VERIFY_COST) / match) + length
        better = (this < cost) & (match <= least_overlap(n))
        best[better], cost[better] = match, this[better]
    length = np.minimum(spare + best, n)
    at = np.arange(len(values)) - np.repeat(bounds[:-1], n)
    cut = np.zeros(len(bounds), np.int64)
    np.cumsum(length, out=cut[1:])
    return values[at < np.repeat(length, n)], cut, best


def document_sets(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, matches, prefix``; documents with equal sets have one ``node``."""
    shared = texts.sparkSession.sparkContext.broadcast(table)  # COUNTERS values

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, bounds = distinct_in_texts(*shingles(Words(batch.column("text"))))
            node = [xxhash.xxh3_64_intdigest(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            prefix, cut, match = prefixes(values, bounds, shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(np.diff(bounds)),
                    pa.array(np.array(node, np.uint64).view(np.int64)),
                    pa.array(match.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(prefix.view(np.int64))),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "matches", "prefix"],
            )

    return texts.mapInArrow(describe, "doc_id long, text_key long, n_shingles long, node long, matches int, prefix array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes whose texts are similar enough.

    Texts meet in runs: first the text of ``a``, then those compared with it, streamed. A node with many
    pairs has many runs. Texts of no pair stay out of the shuffle.
    """
    texts = only_these(texts, pairs.select(F.explode(F.array("a", "b")).alias("node")), "node").dropDuplicates(["node"])
    width = F.ceil(F.count("*").over(Window.partitionBy("a")) / COMPARED_AT_ONCE)
    pairs = pairs.withColumn("run", F.pmod(F.xxhash64("b"), width).cast("int"))
    heads = pairs.select("a", "run").distinct()
    a, b = texts.select(F.col("node").alias("a"), "text"), texts.select(F.col("node").alias("b"), "text")
    heads = heads.join(a, "a").select("a", "run", F.lit(None).cast("long").alias("b"), "text")
    rows = pairs.join(b, "b").select("a", "run", "b", "text").unionByName(heads)
    rows = rows.repartition(parts(pairs), "a", "run").sortWithinPartitions("a", "run", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch in slices(batches, "text"):
            values, bounds = distinct_in_texts(*shingles(Words(batch.column("text"))))
            out = []
            for i, (x, y) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                these = values[bounds[i] : bounds[i + 1]]
                if y is None:
                    head = these
                    continue
                common = len(np.intersect1d(head, these, assume_unique=True))
                if 100 * common >= PERCENT * (len(head) + len(these) - common):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def close_in_size(n: str, m: str) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def shared_needed(n: str, l: str, m: str, k: str) -> Column:  # noqa: E741
    """Prefix shingles that two sets of sizes ``n`` and ``m`` with ``l`` and ``k`` matches required must share.

    One of the two prefixes ends first in the global order. All common shingles up to there are in both
    prefixes; the others are beyond that prefix, so they are no more than what it leaves of its set. What is
    missing to the least overlap must be shared within the prefixes.
    """
    beyond = lambda size, match: F.greatest(F.lit(0), F.floor((size * PERCENT + 99) / 100) - match)
    overlap = F.ceil((F.col(n) + F.col(m)) * PERCENT / (100 + PERCENT))
    return F.greatest(F.least(l, k), overlap - F.greatest(beyond(F.col(n), F.col(l)), beyond(F.col(m), F.col(k))))


def met_tokens(usable: DataFrame) -> DataFrame:
    """``token, node`` of prefix shingles that several nodes hold, each once.

    Nearly all shingles have one node. So they are dealt out and sorted once, and a row stays if the row of another
    node before or after it has the same shingle; no shingle's rows are held together.
    """
    tokens = usable.select(F.explode("prefix").alias("token"), "node")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lambda token, node: pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(node, pa.int64())], ["token", "node"])
        last_token = last_node = np.zeros(0, np.int64)
        stays = False
        for batch in batches:
            if not batch.num_rows:
                continue
            token, node = np.append(last_token, batch.column("token").to_numpy()), np.append(last_node, batch.column("node").to_numpy())
            new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
            token, node = token[new], node[new]
            same = token[1:] == token[:-1]
            kept = np.append(stays, same) | np.append(same, False)
            yield rows(token[:-1][kept[:-1]], node[:-1][kept[:-1]])
            last_token, last_node, stays = token[-1:], node[-1:], bool(kept[-1])
        if stays:
            yield rows(last_token, last_node)

    dealt = tokens.repartition(parts(usable), "token").sortWithinPartitions("token", "node")
    return stage(dealt.mapInArrow(met, "token long, node long"), "held")


def same_nodes(held: DataFrame) -> DataFrame:
    """``token, node, w``: the shingles that the same nodes hold as one token, ``w`` of them.

    A passage that many texts share gives the same pairs for each of its shingles; so it gives them once.
    Sets of nodes are told apart by a hash. If two had the same, a pair's smaller ``w`` would still be no
    less than the shingles that it shares, so that only a comparison is added. Tokens of ``CROWD`` nodes are not
    negative, all others are.
    """
    hashed = F.bit_xor(F.xxhash64("node"))
    sign = F.when(F.count("*") >= CROWD, hashed.bitwiseAND(F.lit(2**63 - 1))).otherwise(hashed.bitwiseOR(F.lit(-(2**63))))
    sets = held.groupBy("token").agg(sign.alias("set"))
    return held.join(sets, "token").groupBy(F.col("set").alias("token"), "node").agg(F.count("*").alias("w"))


def share_enough(group: pa.Table, crowded: bool) -> pa.Table:
    """``a, b, shared, need`` of one pair of chunks of a token's nodes: the pairs that this token answers for.

    A pair of nodes of different components belongs to its first common token. If one of the two has so many
    tokens that postings carry only those whose last ``bits`` bits agree, the pair has a part of its count from
    the first common token of each such block, and is judged after adding these. With ``crowded``, a token that is
    not has only such pairs left.
    """
    token, i, j = (group.column(c)[0].as_py() for c in ("token", "i", "j"))
    node, n, l, root, bits, chunk = (group.column(c).to_numpy() for c in ("node", "n", "l", "root", "bits", "chunk"))  # noqa: E741
    a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    least, most = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
    mine = np.not_equal.outer(root[a], root[b]) & (least * 100 >= most * PERCENT)
    if i == j:
        mine &= np.less.outer(node[a], node[b])
    shared, depth = np.zeros(mine.shape, np.int64), np.maximum.outer(bits[a], bits[b])
    if crowded and token < 0:
        mine &= depth > 0
    if mine.any():
        lists = group.column("carried").combine_chunks()
        owner = np.repeat(np.arange(len(node)), lists.value_lengths().to_numpy())
        items = lists.flatten()
        held, weight = items.field("token").to_numpy(), items.field("w").to_numpy()
        order = np.argsort(held, kind="stable")
        held, weight, owner = held[order], weight[order], owner[order]
        place = np.zeros((2, len(node)), np.int64)
        place[0, a], place[1, b] = np.arange(len(a)), np.arange(len(b))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(held)) + 1, [len(held)]])
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            rows, w = owner[start:end], weight[start:end]
            left, right = chunk[rows] == i, chunk[rows] == j
            if end - start < 2 or not (left.any() and right.any()):
                continue
            at = np.ix_(place[0, rows[left]], place[1, rows[right]])
            other = int(held[start])
            differ = (other ^ token) & -(other ^ token)
            here = depth[at] < differ.bit_length() if differ else True
            if other < token:
                mine[at] &= ~here
            else:
                shared[at] += np.where(here, np.minimum.outer(w[left], w[right]), 0)
    x, y = np.nonzero(mine)
    shared, whole, x, y = shared[x, y], depth[x, y] == 0, a[x], b[y]
    beyond = np.maximum(0, least_overlap(n) - l)
    overlap = -(-(n[x] + n[y]) * PERCENT // (100 + PERCENT))
    need = np.maximum(np.minimum(l[x], l[y]), overlap - np.maximum(beyond[x], beyond[y]))
    some = ~whole | (shared >= need)
    first, second = np.minimum(node[x], node[y])[some], np.maximum(node[x], node[y])[some]
    return pa.table({"a": pa.array(first), "b": pa.array(second), "shared": pa.array(shared[some]), "need": pa.array(need[some].astype(np.int64))})


def candidates(live: DataFrame, crowded: bool) -> DataFrame:
    """Pairs ``a, b`` of nodes of different components that share enough prefix shingles.

    ``live``: ``token, node, n, l, w, bits, root, main``. A token's nodes outside its largest component meet all of its
    nodes, chunk by chunk; those within it need not meet each other. First come the pairs that have a token in
    common that is not ``crowded``, then all others: with those, the tokens sort behind.
    """
    rows = live.withColumn("in_main", F.col("root") == F.col("main")).withColumn("block", F.expr("token & (shiftleft(1L, bits) - 1)"))
    carried = rows.groupBy("node", "block").agg(F.collect_list(F.struct("token", "w")).alias("carried"))
    many = lambda which: F.ceil(F.count_if(which) / CHUNK).cast("int")
    meeting = F.expr("token >= 0 OR most_bits > 0" if crowded else "token < 0")
    chunks = rows.groupBy("token").agg(many(~F.col("in_main")).alias("others"), many("in_main").alias("mains"), F.max("bits").alias("most_bits")).where(meeting)
    rows = rows.join(carried, ["node", "block"]).join(chunks, "token")
    at = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    rows = rows.withColumn("chunk", F.when(F.col("in_main"), F.col("others") + at("mains")).otherwise(at("others")))
    meets = F.sequence(F.lit(0), F.when(F.col("in_main"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)
    rows = rows.withColumn("other", F.explode(meets)).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
    rows = rows.select("token", "i", "j", "chunk", "node", "n", F.col("l").cast("long").alias("l"), "root", "bits", "carried")
    key = ["token", "i", "j"]
    rows = rows.repartition(parts(live), *key).sortWithinPartitions(*key)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, key):
            yield from share_enough(group, crowded).to_batches()

    found = rows.mapInArrow(count, "a long, b long, shared long, need long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).where("shared >= need").select("a", "b")


def link_components(postings: DataFrame, texts: DataFrame) -> DataFrame | None:
    """``node, root`` of all nodes that links connect to a smaller node.

    ``postings``: ``token, node, n, l, w, bits, central``; a token stands for ``w`` shingles of one set of nodes. The
    first round takes the nodes of largest ``central`` as pivots; those after the pairs of tokens that are not crowded
    draw them by a hash of the node and the round; all tokens draw alike.
    """
    edges = roots = None

    def grow(pairs: DataFrame, label: str) -> bool:
        nonlocal edges, roots
        found = stage(verified(stage(pairs, label), texts), "links")
        merged = bool(found.head(1))
        if merged:
            edges = found if edges is None else edges.unionByName(found)
            roots = connected_components(edges)
        return merged

    def mains(rows: DataFrame, turn: int) -> DataFrame:
        """Each token's largest component and one node of it, for tokens that hold several components."""
        draw = F.xxhash64("node", F.lit(turn)) if turn else -F.col("central")
        drawn = F.struct(draw.alias("draw"), "node", "n", "l", "w")
        by_root = rows.groupBy("token", "root").agg(F.count("*").alias("k"), F.min(drawn).alias("first"))
        main = F.struct(F.col("root").alias("main"), *(F.col(f"first.{c}").alias(d) for c, d in (("node", "pivot"), ("n", "pivot_n"), ("l", "pivot_l"), ("w", "pivot_w"))))
        by_token = by_root.groupBy("token").agg(
            F.max_by(main, F.struct("k", -F.col("first.draw"), -F.col("root"))).alias("m"), F.sum("k").alias("nodes"), (F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("pairs")
        )
        return by_token.where("pairs > 0").select("token", "m.*", "nodes", "pairs")

    def open_tokens(turn: int) -> tuple[DataFrame, int, int]:
        """The postings of tokens that hold several components, their number, and the pairs of crowded tokens."""
        rows = postings.withColumn("root", F.col("node"))
        if roots is not None:
            rows = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        main = stage(mains(rows, turn), "mains")
        nodes, pairs = main.agg(F.sum("nodes"), F.sum(F.when(F.col("token") >= 0, F.col("pairs"))) / 2).first()
        return stage(rows.join(main.drop("nodes", "pairs"), "token"), "live"), nodes or 0, pairs or 0

    def star(live: DataFrame) -> DataFrame:
        near = live.where("root <> main").where(close_in_size("n", "pivot_n"))
        near = near.groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(
            F.sum(F.least("w", "pivot_w")).alias("shared"), F.max(shared_needed("n", "l", "pivot_n", "pivot_l")).alias("need")
        )
        return near.where("shared >= need").select("a", "b")

    live, nodes, before = open_tokens(0)
    if not nodes:
        return roots
    grow(star(live), "star")
    live, _, _ = open_tokens(0)
    grow(candidates(live, crowded=False), "candidates")
    for turn in range(1, STAR_ROUNDS + 1):
        live, nodes, pairs = open_tokens(turn)
        if pairs <= PAIRS_PER_POSTING * nodes or pairs > WORTH_A_ROUND * before or not grow(star(live.where("token >= 0")), "star"):
            break
        before = pairs
    # every pair of different components has a node outside the token's largest one
    grow(candidates(live, crowded=True), "candidates")
    return roots


def only_these(texts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``texts`` whose ``key``, a hash, may be among ``keys``, by a bit table of fixed size.

    It lets through all rows that are wanted and some others, so that few texts enter the join after it.
    """
    span = FILTER_BITS // 8 // RANGES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = (batch.column(key).to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        packed = [zlib.compress(bits[k * span : (k + 1) * span].tobytes(), 1) for k in range(RANGES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array(packed, pa.binary())], ["span", "bits"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("span").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                total[k] = total.get(k, np.uint8(0)) | np.frombuffer(zlib.decompress(raw), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["span", "bits"])

    rows = keys.select(key).mapInArrow(mark, "span int, bits binary").repartition(min(RANGES, parts(keys)), "span").mapInArrow(unite, "span int, bits binary")
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows.collect():  # FILTER_BITS bits in all
        bits[row.span * span : (row.span + 1) * span] = np.frombuffer(row.bits, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (batch.column(key).to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)
            yield batch.filter(pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return texts.mapInArrow(some, texts.schema)


def join_components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Lower-cased (A-Z) words outside white space; sets of distinct 5-word shingles; a shorter text is one
    shingle. Documents link when 100 * intersection >= 80 * union. A text without words is empty and links
    with nothing. ``component_id`` is the smallest id reachable by links, its own included. Rows of one id
    count as linked; rows without id link with nothing and have no component. An empty table gives an empty
    result. Other columns are not read.
    """
    texts = id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    sets = stage(document_sets(texts, frequency_table(texts)), "sets")
    usable = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    several = stage(same_nodes(met_tokens(usable)), "postings")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / CARRIED))).cast("int")
    met = several.groupBy("node").agg(F.sum("w").alias("kept"), bits.alias("bits"))
    first = usable.join(met, "node").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("n_shingles").alias("n"), F.max("matches").alias("l"), F.max("kept").alias("kept"), F.max("bits").alias("bits"))
    text_id = F.xxhash64("doc_id", "text_key")
    # an original has few shingles of its own, so most of its prefix is shared
    prefix = F.least("n", F.floor(F.col("n") * (100 - PERCENT) / 100) + F.col("l"))
    first = stage(first.select("node", "first.*", "n", "l", "bits", (F.col("kept") / prefix).alias("central")).withColumn("text_id", text_id), "nodes")
    # from here a node goes by its text's id, so that texts need no shuffle to find their node
    postings = several.join(first.select("node", "text_id", "n", "l", "bits", "central"), "node").drop("node").withColumnRenamed("text_id", "node")
    roots = link_components(postings, texts.select(text_id.alias("node"), "text"))  # read again when compared, not written
    if roots is not None:
        named = first.select("node", "text_id")
        roots = roots.join(named.withColumnRenamed("text_id", "at"), F.col("at") == roots["node"]).select(named["node"], "root")
        roots = roots.join(first.select(F.col("node").alias("first_node"), "text_id"), F.col("text_id") == F.col("root")).select("node", F.col("first_node").alias("root"))

    members = usable.select("doc_id", "node").distinct()
    if roots is not None:
        members = members.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("node"))
    twice = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    if twice.head(1):  # ids with several sets
        more = connected_components(members.join(twice.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")))
        members = members.join(more, "node", "left").select("doc_id", F.coalesce("root", "node").alias("node"))
    heads = members.groupBy("node").agg(F.min("doc_id").alias("head"))
    members = members.distinct().join(heads, "node").select("doc_id", "head")
    out = sets.select("doc_id", "n_shingles").join(members, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("head", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One document of each component, that of the smallest id, all columns as they were.

    Rows of one id stay or go together; documents without words or id stay.
    """
    gone = join_components(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("i"))
    return rows.join(gone.hint("shuffle_hash"), rows["i"] == gone["gone"], "left_anti").select("row.*")
