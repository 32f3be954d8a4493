"""A hierarchical Pitman-Yor language model, seated over the whole corpus and scored on every text.

A restaurant stands for a context, the word before; all contexts share one parent, the unigram restaurant,
whose base is uniform over the known words and one unknown. Customers are the training tokens. A sweep
reseats, dish by dish, each word's customers in each restaurant one after the other, given all other seats
and the parent's current probabilities; each table sends one customer to the parent. Probabilities are
averaged over the sweeps after the first.

Spark deals all tokens out by word, so a word's customers in every context, its tables and its probability
are together; a part is one row of a staged table. There are as many parts as the texts' bytes ask for. Texts
are packed in batches, and a part knows a text by its batch and its place there: it sends one row of sums for
each batch, and the batch's ids meet them at the end. A frequent word, which would fill a part, is dealt out by
word and context: the parts send the sums of its customers and get its totals back. The texts of a pair of
word and context that would still fill a part are dealt out apart from its counts. There are as many restaurants as contexts, told apart by
the hash of the word, and their totals stay in Spark: each sweep every part sends its sums, one for each of
its contexts, to the spans of contexts, where they are added up, and gets the totals of its own contexts
back. A context has one sum for each part at most, so none is hot. Every sweep's seats follow from seeds and
those totals, so a part that is lost is seated again in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_fold, id_text, slices, stage
from tidemark.llm.text import Words, mix

FOLDS, HELD_OUT = 5, 1
SWEEPS, BURN_IN = 3, 1
STRENGTH, ROOT_STRENGTH = 1.0, 10.0
#: Bytes of text whose tokens make a part, so that one fits a worker, and parts and spans at least, so that all workers
#: have some.
PART_BYTES, LEAST_PARTS, LEAST_SPANS = 8 << 20, 16, 32
#: Tokens that a task packs at once; customers seated one by one before seating goes in leaps.
PACKED_TOKENS, LEAP = 1_500_000, 16
_END, _BEGIN = np.uint64(0x5EED0E0D5EED0E0D), np.uint64(0x5EEDBE615EEDBE61)
#: What a message between parts and spans holds, beside totals: the names of contexts, or their places in a span.
_NAMES, _PLACES, _CUSTOMERS = -2, -1, 0


def small(x: np.ndarray) -> bytes:
    """Integers from 0 on in as few bytes as the largest needs, all lowest bytes first."""
    width = max(1, -(-int(x.max() if len(x) else 0).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def large(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<i8").reshape(-1)


def ranged(hashes: np.ndarray, n: int) -> np.ndarray:
    """The range of each 64-bit hash among ``n`` equal ones, in their order."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word hash, context, text)`` of every token: lower-cased words, then one end per text."""
    words = Words(texts)
    counts = words.counts
    total = int(counts.sum()) + len(words)
    ends = np.cumsum(counts + 1) - 1
    word = np.empty(total, np.uint64)
    is_word = np.ones(total, bool)
    is_word[ends] = False
    word[is_word], word[ends] = words.hashes(), _END
    context = np.empty(total, np.uint64)
    context[1:] = word[:-1]
    context[np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends] = _BEGIN
    return word, context, np.repeat(np.arange(len(words), dtype=np.uint32), counts + 1)


def pair_hash(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word ^ mix(context + np.uint64(1)))


def found(sought: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each value in a sorted table, or -1."""
    if not len(table):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(table, sought), len(table) - 1)
    return np.where(table[at] == sought, at, -1)


@dataclass
class Frequent:
    """Words, and pairs of word and context, of about a part's share of all tokens or more: fewer than two for
    each part. Words are in the order of their hashes, pairs in that of the pairs' hashes."""

    words: np.ndarray
    pair_words: np.ndarray
    pair_contexts: np.ndarray

    def pairs(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The place of each pair, or -1."""
        at = found(pair_hash(word, context), pair_hash(self.pair_words, self.pair_contexts))
        if not len(self.pair_words):
            return at
        return np.where((self.pair_words[at] == word) & (self.pair_contexts[at] == context), at, -1)

    def home(self, word: np.ndarray, context: np.ndarray, n_parts: int) -> np.ndarray:
        """The part of each pair's counts."""
        split = found(word, self.words) >= 0
        return np.where(split, ranged(pair_hash(word, context), n_parts), ranged(word, n_parts))


def part_count(texts: DataFrame) -> int:
    """As many parts as the texts are long, whatever the session's partitions are."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_PARTS, -(-size // PART_BYTES))


def span_count(n_parts: int) -> int:
    """Spans of contexts. With the root of the parts, messages grow less than parts times parts, and so does a span."""
    return max(LEAST_SPANS, int(np.ceil(4 * np.sqrt(n_parts))))


def frequent(texts: DataFrame, n_parts: int) -> Frequent:
    """Counted with the tokens of some texts at a time: those below a quarter of a part's share there add up to
    a quarter at most, so whatever fills a part keeps three quarters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            word, context, _ = tokens(batch.column("text"))
            out = [(0, 0, 0, len(word))]
            least = len(word) / (4 * n_parts)
            values, times = np.unique(word, return_counts=True)
            common = values[times >= least]
            out += [(1, x, 0, n) for x, n in zip(common.view(np.int64).tolist(), times[times >= least].tolist(), strict=True)]
            some = found(word, common) >= 0
            word, context = word[some], context[some]
            order = np.lexsort((context, word))
            word, context = word[order], context[order]
            if len(word):
                starts, _ = runs(word, context)
                times = np.diff(np.append(starts, len(word)))
                starts, times = starts[times >= least], times[times >= least]
                out += [(2, w, c, n) for w, c, n in zip(word[starts].view(np.int64).tolist(), context[starts].view(np.int64).tolist(), times.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), *3 * [pa.int64()]), strict=True)], ["kind", "word", "context", "times"])

    counted = texts.select("text").mapInArrow(count, "kind int, word long, context long, times long")
    counted = stage(counted.groupBy("kind", "word", "context").agg(F.sum("times").alias("times")), "frequent")
    total = counted.where("kind = 0").agg(F.sum("times")).first()[0] or 0
    rows = counted.where(F.col("kind") > 0).where(F.col("times") >= 0.75 * total / n_parts).collect()  # 8 / 3 for each part at most
    of = lambda k, c: np.array([r[c] for r in rows if r.kind == k], np.int64).view(np.uint64)
    word, context = of(2, "word"), of(2, "context")
    order = np.argsort(pair_hash(word, context))
    return Frequent(np.sort(of(1, "word")), word[order], context[order])


def pack_by_word(n_parts: int, frequent: Frequent):
    """Tokens of a batch of texts as one row for each part, dealt out by ranges of the word hash, or of the pair's
    for frequent words: for each word its contexts, for each of those the count of training tokens and the texts of
    all its tokens, by their places in the batch. Of frequent pairs only the count; their texts come in a row of a
    part beyond ``n_parts``, with the pair and the number of times for each. A row of a part below zero has the
    batch's ids, folds and lengths."""

    def flush(held: list, batch: int, salt: int) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        base = np.cumsum([0] + [len(h[4]) for h in held])
        word, context = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        text = np.concatenate([h[2] + np.uint32(b) for h, b in zip(held, base, strict=False)])
        train, n = np.concatenate([h[4] for h in held]), int(base[-1])
        ids = pa.concat_arrays([h[3] for h in held])
        unknown = ids.is_null().to_numpy(zero_copy_only=False)
        who = {"ids": ids.fill_null(0).to_numpy().tobytes(), "unknown": unknown.tobytes(), "train": train.tobytes(), "length": small(np.bincount(text, minlength=n))}
        rows = [{"part": -1 - salt % n_parts, "batch": batch, "size": n} | who]

        def put(part: int, words: np.ndarray, entries: np.ndarray, contexts: np.ndarray, *more: np.ndarray) -> None:
            values = (words.tobytes(), small(entries), contexts.tobytes(), *map(small, more))
            rows.append({"part": part, "batch": batch, "size": n} | dict(zip(_COUNTED, values, strict=True)))

        none = np.zeros(0, np.int64)
        pair = frequent.pairs(word, context)
        if (pair >= 0).any():
            some = np.flatnonzero(pair >= 0)
            learnt = np.bincount(pair[some], train[text[some]], minlength=len(frequent.pair_words)).astype(np.int64)
            mine = np.unique(pair[some])
            home = frequent.home(frequent.pair_words[mine], frequent.pair_contexts[mine], n_parts)
            for k in np.unique(home).tolist():
                here = mine[home == k]
                put(k, frequent.pair_words[here], np.ones(len(here), int), frequent.pair_contexts[here], learnt[here], 0 * here, none)
            both, times = np.unique(text[some].astype(np.int64) * len(learnt) + pair[some], return_counts=True)
            put(n_parts + salt % n_parts, none, both % len(learnt), none, none, times, both // len(learnt))
            word, context, text = word[pair < 0], context[pair < 0], text[pair < 0]
        at = frequent.home(word, context, n_parts)
        order = np.lexsort((context, word, at))
        word, context, text, at = word[order], context[order], text[order], at[order]
        starts, new_word = runs(word, context)
        part = at[starts]
        new_word |= np.concatenate([[True], part[1:] != part[:-1]])[: len(part)]
        customers = np.add.reduceat(train[text].astype(np.int64), starts) if len(starts) else none
        ends = np.append(starts[1:], len(word))
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else none
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            first = np.flatnonzero(new_word[a:b])
            put(int(part[a]), word[starts[a:b]][first], np.diff(np.append(first, b - a)), context[starts[a:b]], customers[a:b], ends[a:b] - starts[a:b], text[starts[a] : ends[b - 1]])
        yield pa.RecordBatch.from_pylist(rows, pa.schema([(c, _TYPES.get(c, pa.binary())) for c in _PACKED]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, salt = [], 0, (task := TaskContext.get().partitionId())
        for batch in slices(batches, "text"):
            got = tokens(batch.column("text"))
            held.append((*got, batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False)))
            n += len(got[0])
            if n >= PACKED_TOKENS:
                yield from flush(held, task << 32 | salt - task, salt)
                held, n, salt = [], 0, salt + 1
        yield from flush(held, task << 32 | salt - task, salt)

    return pack


_COUNTED = ("words", "entries", "contexts", "customers", "tokens", "texts")
_WHO = ("ids", "unknown", "train", "length")
_PACKED = ("part", "batch", "size", *_COUNTED, *_WHO)
_BUILT = ("part", "entries", "names", "contexts", "customers", "split", "pair_at", "pairs", "tokens", "texts", "batches", "batch_sizes")
_PART = (*_BUILT, "batch", "size", *_WHO)
_TYPES = {"part": pa.int32(), "batch": pa.int64(), "size": pa.int32()}
_MESSAGE = "span int, part int, n int, x binary, number long"


def schema(names: tuple[str, ...]) -> str:
    return ", ".join(f"{c} {'long' if c == 'batch' else 'int' if c in _TYPES else 'binary'}" for c in names)


def runs(word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of one word and context, and which of those runs start a word."""
    new_word = np.concatenate([[True], word[1:] != word[:-1]])[: len(word)]
    starts = np.flatnonzero(new_word | np.concatenate([[True], context[1:] != context[:-1]])[: len(word)])
    return starts, new_word[starts]


def part_builder(n_parts: int, frequent: Frequent):
    """A part's words, sorted: for each its contexts, for each of those the training count and the texts of
    its tokens, numbered through its ``batches`` of ``batch_sizes`` texts. Contexts are numbered within the part, in the order
    of their hashes. ``split`` is a frequent word's place, from 1 on; ``pair_at`` and ``pairs`` are the entries and
    places of frequent pairs. A part beyond ``n_parts`` has those pairs' texts. Batches' ids stay as they are."""

    def one(rows: pa.Table, made: dict) -> pa.Table:
        return pa.table({"part": rows.column("part").slice(0, 1)} | {c: pa.array([made.get(c)], _TYPES.get(c, pa.binary())) for c in _PART[1:]})

    def build_part(rows: pa.Table) -> pa.Table:
        if rows.column("part")[0].as_py() < 0:
            none = pa.nulls(rows.num_rows, pa.binary())
            return pa.table({c: rows.column(c) if c in _PACKED and c not in _COUNTED else none for c in _PART})
        word, context, customers, times, text, pairs, base = [], [], [], [], [], [], 0
        spread = rows.column("part")[0].as_py() >= n_parts
        rows = rows.sort_by("batch")
        first_text = {}
        for row in rows.to_pylist():
            entries = large(row["entries"])
            pairs.append(entries)
            word.append(np.repeat(np.frombuffer(row["words"], np.uint64), 0 if spread else entries))
            context.append(np.frombuffer(row["contexts"], np.uint64))
            customers.append(large(row["customers"]))
            times.append(large(row["tokens"]))
            if row["batch"] not in first_text:
                first_text[row["batch"]] = base
                base += row["size"]
            text.append((large(row["texts"]) + first_text[row["batch"]]).astype(np.uint32))
        word, context, customers, times, text = map(np.concatenate, (word, context, customers, times, text))
        of_batches = {"batches": np.array(list(first_text), np.int64).tobytes(), "batch_sizes": small(np.diff([*first_text.values(), base]))}
        if spread:
            return one(rows, {"pairs": small(np.concatenate(pairs)), "tokens": small(times), "texts": small(text)} | of_batches)
        order = np.lexsort((context, word))
        first = (np.cumsum(times) - times)[order]
        word, context, customers, times = word[order], context[order], customers[order], times[order]
        text = text[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(len(text))]
        starts, new_word = runs(word, context)
        pair = frequent.pairs(word[starts], context[starts])
        names, local = np.unique(context[starts], return_inverse=True)
        made = {
            "entries": small(np.bincount(np.cumsum(new_word) - 1)),
            "names": names.tobytes(),
            "contexts": small(local),
            "customers": small(np.add.reduceat(customers, starts)),
            "split": small(found(word[starts][new_word], frequent.words) + 1),
            "pair_at": small(np.flatnonzero(pair >= 0)),
            "pairs": small(pair[pair >= 0]),
            "tokens": small(np.add.reduceat(times, starts)),
            "texts": small(text),
        }
        return one(rows, made | of_batches)

    return build_part


@dataclass
class Totals:
    """What all parts share: token and word counts, discounts, and each sweep's totals of the root and of
    frequent words in it; and, of one part's contexts, the customers and each sweep's tables."""

    tokens: int = 0
    words: int = 0
    discount: float = 0.5
    root_discount: float = 0.5
    customers: np.ndarray | None = None
    tables: list[np.ndarray] = field(default_factory=list)
    root_customers: list[int] = field(default_factory=list)
    root_tables: list[int] = field(default_factory=list)
    split_counts: np.ndarray | None = None
    split_customers: list[np.ndarray] = field(default_factory=list)
    split_tables: list[np.ndarray] = field(default_factory=list)


def seat(rng: np.random.Generator, customers: np.ndarray, tables: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Reseat each dish's customers one by one: the tables they take, given the tables of other dishes.

    The j-th customer opens a table with weight (strength + discount * all tables) * base against the
    customers seated less the discount for each table. From ``LEAP`` customers on, a sixteenth of those
    seated come at once with the same weights.
    """
    out = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    seated = 1
    while len(live):
        step = np.minimum(max(1, seated // LEAP), customers[live] - seated)
        own = out[live]
        opens = (strength + discount * (others[live] + own)) * base[live]
        chance = opens / (opens + seated - discount * own)
        out[live] += rng.random(len(live)) < chance if seated < LEAP else rng.binomial(step, chance)
        seated += max(1, seated // LEAP)
        live = live[customers[live] > seated]
    return out


class Part:
    """One part's words: their contexts, training counts and tokens, and the seats of the sweeps."""

    def __init__(self, row: dict):
        read = lambda name, kind=np.uint32: np.frombuffer(row[name], kind)
        self.part, entries = row["part"], read("entries")
        self.word = np.repeat(np.arange(len(entries)), entries)
        self.first = np.concatenate([[0], np.cumsum(entries)[:-1]]).astype(np.int64)
        self.context, self.customers = read("contexts").astype(np.int64), read("customers").astype(np.int64)
        self.count = np.add.reduceat(self.customers, self.first)
        self.split = large(row["split"]) - 1 if row.get("split") else np.full(len(entries), -1)
        self.row = row

    def whole(self, totals: Totals, n: int, tables: np.ndarray, in_root: np.ndarray, root_tables: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The seats after ``n`` sweeps with the totals, if known, of words that other parts hold too."""
        some = self.split >= 0
        if some.any() and n < len(totals.split_customers):
            in_root[some], root_tables[some] = (x[n][self.split[some]] for x in (totals.split_customers, totals.split_tables))
        return tables, in_root, root_tables

    def sweeps(self, totals: Totals) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per sweep whose totals are known, and the next: tables per entry, customers and tables per word."""
        seated = self.customers > 0
        tables = seated.astype(np.int64)
        in_root = np.add.reduceat(tables, self.first)
        root_tables = (in_root > 0).astype(np.int64)
        yield self.whole(totals, 0, tables, in_root, root_tables)
        for n in range(len(totals.tables)):
            rng = np.random.default_rng([n, self.part])
            p = self.root_probability(totals, n, in_root, root_tables)
            others = totals.tables[n][self.context] - tables
            tables = seat(rng, self.customers, tables, others, p[self.word], totals.discount, STRENGTH)
            in_root = np.add.reduceat(tables, self.first)
            base = np.full(len(in_root), 1 / (totals.words + 1))
            root_tables = seat(rng, in_root, root_tables, totals.root_tables[n] - root_tables, base, totals.root_discount, ROOT_STRENGTH)
            yield self.whole(totals, n + 1, tables, in_root, root_tables)

    @staticmethod
    def root_probability(totals: Totals, n: int, in_root: np.ndarray, root_tables: np.ndarray) -> np.ndarray:
        d = totals.root_discount
        rest = (ROOT_STRENGTH + d * totals.root_tables[n]) / (totals.words + 1)
        return (in_root - d * root_tables + rest) / (ROOT_STRENGTH + totals.root_customers[n])

    def last_sweep(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        *_, last = self.sweeps(totals)
        return last

    def probabilities(self, totals: Totals) -> np.ndarray:
        """Each entry's predictive probability, averaged over the sweeps after ``BURN_IN``."""
        total = np.zeros(len(self.context))
        for n, (tables, in_root, root_tables) in enumerate(self.sweeps(totals)):
            if BURN_IN < n < len(totals.tables):
                p = self.root_probability(totals, n, in_root, root_tables)[self.word]
                open_weight = STRENGTH + totals.discount * totals.tables[n][self.context]
                total += (self.customers - totals.discount * tables + open_weight * p) / (STRENGTH + totals.customers[self.context])
        return total / (len(totals.tables) - 1 - BURN_IN)


def opened(rows: pa.Table, shared: Totals) -> tuple[Part, dict, Totals]:
    """A part, its row, and its totals: what is shared and what the spans have sent to it."""
    *replies, row = sorted(rows.to_pylist(), key=lambda r: (r["n"] is None, r["n"] or 0, r["span"] or 0))
    for name in ("entries", "contexts", "customers"):
        row[name] = large(row[name]).astype(np.uint32).tobytes()
    arrays: dict[int, list[np.ndarray]] = {}
    for r in replies:
        arrays.setdefault(r["n"], []).append(large(r["x"]))
    row["spans"] = [r["span"] for r in replies if r["n"] == _CUSTOMERS]
    row["sizes"] = [len(x) for x in arrays.get(_CUSTOMERS, [])]
    by_n = [np.concatenate(arrays[n]) for n in sorted(arrays)]
    return Part(row), row, replace(shared, customers=by_n[0] if by_n else None, tables=by_n[1:])


def messages(part: Part, spans: np.ndarray, arrays: dict[int, np.ndarray], numbers: list[int], split: np.ndarray) -> pa.Table:
    """A part's arrays by context, cut at the spans, its numbers, and after them its sums of frequent words, as rows of ``_MESSAGE``."""
    edges = np.flatnonzero(np.concatenate([[True], spans[1:] != spans[:-1], [True]]))
    rows = [(-1 - i, part.part, None, None, int(x)) for i, x in enumerate(numbers)]
    rows += [(-1 - len(numbers) - i, part.part, None, None, x) for i, x in enumerate(split.tolist()) if x]
    for n, x in arrays.items():
        rows += [(int(spans[a]), part.part, n, x[a:b].tobytes() if n == _NAMES else small(x[a:b]), None) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["span", "part", "n", "x", "number"])


def add_up(rows: pa.Table) -> pa.Table:
    """The totals of a span's contexts over all parts, as replies to each part in the order of its contexts.

    With names, the contexts' places in the span come too, for later sweeps. Below zero: one number's total.
    """
    span = rows.column("span")[0].as_py()
    if span < 0:
        out = [(span, -1, None, None, sum(rows.column("number").to_pylist()))]
    else:
        sent: dict[int, dict[int, bytes]] = {}
        for part, n, x in zip(*(rows.column(c).to_pylist() for c in ("part", "n", "x")), strict=True):
            sent.setdefault(n, {})[part] = x
        out = []
        if _NAMES in sent:
            names = {part: np.frombuffer(x, np.uint64) for part, x in sent.pop(_NAMES).items()}
            cut = np.cumsum([len(x) for x in names.values()])[:-1]
            places = dict(zip(names, np.split(np.unique(np.concatenate(list(names.values())), return_inverse=True)[1], cut), strict=True))
            out += [(span, part, _PLACES, small(x), None) for part, x in places.items()]
        else:
            places = {part: large(x) for part, x in sent.pop(_PLACES).items()}
        for n, sums in sent.items():
            total = np.zeros(1 + max(int(x.max()) for x in places.values()), np.int64)
            for part, x in sums.items():
                total[places[part]] += large(x)
            out += [(span, part, n, small(total[places[part]]), None) for part in sums]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["span", "part", "n", "x", "number"])


def numbers_of(replies: DataFrame, count: int) -> np.ndarray:
    out = np.zeros(count, np.int64)
    for row in replies.where("span < 0").collect():  # a row for each number
        out[-1 - row.span] = row.number
    return out


def by_split(part: Part, values: np.ndarray, size: int) -> np.ndarray:
    some = part.split >= 0
    return np.bincount(part.split[some], values[some], minlength=size).astype(np.int64)


def by_context(part: Part, weights: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(part.context, weights, minlength=size).astype(np.int64)


def ney_discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def with_replies(rows: DataFrame, replies: list[DataFrame]) -> DataFrame:
    """The parts' rows, each with what the spans have sent to it."""
    rows = rows.withColumn("n", F.lit(None).cast("int")).withColumn("span", F.lit(None).cast("int"))
    for r in replies:
        rows = rows.unionByName(r.where(f"n >= {_CUSTOMERS}").select("part", "n", "span", "x"), allowMissingColumns=True)
    return rows


def sweep(shared: Totals, turn: int):
    def seats(rows: pa.Table) -> pa.Table:
        part, row, own = opened(rows, shared)
        tables, in_root, root_tables = part.last_sweep(own)
        arrays = {turn + 2: by_context(part, tables, len(own.customers))}
        mine = part.split < 0
        split = by_split(part, in_root, len(shared.split_counts))
        return messages(part, np.repeat(row["spans"], row["sizes"]), arrays, [in_root[mine].sum(), root_tables[mine].sum()], split)

    return seats


def fit(built: DataFrame, n_spans: int, n_split: int = 0) -> tuple[Totals, list[DataFrame]]:
    """Count the corpus and run the sweeps; discounts follow from the counts of counts.

    The shared totals, and for each sweep the totals of the contexts as rows for each part.
    """
    model = built.where("entries IS NOT NULL").select("part", "entries", "contexts", "customers", "split")

    def counts(rows: pa.Table) -> pa.Table:
        part, row, _ = opened(rows, Totals())
        names = np.frombuffer(row["names"], np.uint64)
        tables, in_root, root_tables = part.last_sweep(Totals())
        mine = part.split < 0
        of = lambda x, n: int((x == n).sum())
        numbers = [part.count.sum(), (part.count[mine] > 0).sum(), of(part.customers, 1), of(part.customers, 2)]
        numbers += [of(in_root[mine], 1), of(in_root[mine], 2), in_root[mine].sum(), root_tables[mine].sum()]
        arrays = {_NAMES: names, _CUSTOMERS: by_context(part, part.customers, len(names)), 1: by_context(part, tables, len(names))}
        split = np.concatenate([by_split(part, x, n_split) for x in (part.count, in_root)])
        return messages(part, ranged(names, n_spans), arrays, numbers, split)

    first = with_replies(built.where("entries IS NOT NULL").select(*model.columns, "names"), [])
    replies = [stage(first.groupBy("part").applyInArrow(counts, _MESSAGE).groupBy("span").applyInArrow(add_up, _MESSAGE), "context-totals")]
    n = numbers_of(replies[0], 8 + 2 * n_split)
    count, customers = n[8:].reshape(2, n_split)
    tables = (customers > 0).astype(np.int64)
    once, twice = (int(n[3 + k]) + int((customers == k).sum()) for k in (1, 2))
    totals = Totals(int(n[0]), int(n[1] + (count > 0).sum()), ney_discount(int(n[2]), int(n[3])), ney_discount(once, twice))
    totals.root_customers, totals.root_tables = [int(n[6] + customers.sum())], [int(n[7] + tables.sum())]
    totals.split_counts, totals.split_customers, totals.split_tables = count, [customers], [tables]
    places = replies[0].where(f"n = {_PLACES}")
    for turn in range(SWEEPS):
        seats = sweep(totals, turn)
        sent = with_replies(model, replies).groupBy("part").applyInArrow(seats, _MESSAGE).unionByName(places)
        replies.append(stage(sent.groupBy("span").applyInArrow(add_up, _MESSAGE), "context-totals"))
        n = numbers_of(replies[-1], 2 + n_split)
        base = np.full(n_split, 1 / (totals.words + 1))
        customers, others = n[2:], totals.root_tables[-1] - tables
        tables = seat(np.random.default_rng([turn, 0, 1]), customers, tables, others, base, totals.root_discount, ROOT_STRENGTH)
        totals = replace(
            totals,
            root_customers=[*totals.root_customers, int(n[0] + customers.sum())],
            root_tables=[*totals.root_tables, int(n[1] + tables.sum())],
            split_customers=[*totals.split_customers, customers],
            split_tables=[*totals.split_tables, tables],
        )
    return totals, replies


def pair_probabilities(built: DataFrame, totals: Totals, replies: list[DataFrame], size: int) -> np.ndarray:
    """The probability of each frequent pair, from the part that holds its counts."""

    def some(rows: pa.Table) -> pa.Table:
        part, row, own = opened(rows, totals)
        at = large(row["pair_at"])
        return pa.table([pa.array(large(row["pairs"]), pa.int64()), pa.array(part.probabilities(own)[at] if len(at) else [], pa.float64())], ["pair", "p"])

    out = np.ones(size)
    if size:
        model = built.where("entries IS NOT NULL").select("part", "entries", "contexts", "customers", "split", "pair_at", "pairs")
        for row in with_replies(model, replies).groupBy("part").applyInArrow(some, "pair long, p double").collect():  # a row for each pair
            out[row.pair] = row.p
    return out


def deal_out(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, Frequent]:
    """The batches' ids with folds and lengths, the staged parts of all tokens, and the words that are split."""
    fold = crc_fold(F.col(f"`{id_col}`"), FOLDS) != HELD_OUT
    texts = id_text(docs, id_col, text_col, fold.alias("train"))
    n_parts = part_count(texts)
    common = frequent(texts, n_parts)
    packed = texts.mapInArrow(pack_by_word(n_parts, common), schema(_PACKED))
    staged = stage(packed.groupBy("part").applyInArrow(part_builder(n_parts, common), schema(_PART)), "word-parts")
    return staged.where("part < 0").select("batch", "size", *_WHO), staged.where("part >= 0").select(*_BUILT), common


def text_sums(built: DataFrame, totals: Totals, replies: list[DataFrame], common: Frequent) -> DataFrame:
    """``batch, part, texts, n_known, base_score, score``: a row for each part and batch, with the sums of the part's
    tokens in each of the batch's ``texts``, as packed arrays."""
    pair_p = pair_probabilities(built, totals, replies, len(common.pair_words))
    pair_count = totals.split_counts[found(common.pair_words, common.words)] if len(common.words) else np.zeros(0, np.int64)

    def per_batch(row: dict, count: np.ndarray, p: np.ndarray) -> pa.Table:
        """Of the counts of the words and the probabilities of the ``tokens`` each stands for."""
        used, text = np.unique(large(row["texts"]), return_inverse=True)
        times = large(row["tokens"])
        if row["entries"] is None:  # a text and its times, else a text for each of them
            add = lambda x: np.bincount(text, x * times, minlength=len(used))
        else:
            add = lambda x: np.bincount(text, np.repeat(x, times), minlength=len(used))
        base = add(np.log10((count + 0.5) / (totals.tokens + 0.5 * (totals.words + 1))))
        known, score = add(count > 0).astype(np.int64), add(np.log10(p))
        batches, sizes = np.frombuffer(row["batches"], np.int64).tolist(), large(row["batch_sizes"])
        firsts = np.cumsum(sizes) - sizes
        cuts = np.searchsorted(used, [*firsts.tolist(), int(sizes.sum())])
        rows = [
            (batch, row["part"], small(used[a:b] - first), small(known[a:b]), base[a:b].tobytes(), score[a:b].tobytes())
            for batch, first, a, b in zip(batches, firsts, cuts[:-1], cuts[1:], strict=True)
            if b > a
        ]
        types = (pa.int64(), pa.int32(), *4 * [pa.binary()])
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * len(types), types, strict=True)], list(_SUMS))

    def scored(rows: pa.Table) -> pa.Table:
        if rows.num_rows == 1 and not rows.column("entries")[0].is_valid:
            row = rows.to_pylist()[0]
            pair = large(row["pairs"])
            return per_batch(row, pair_count[pair], pair_p[pair])
        part, row, own = opened(rows, totals)
        count, some = part.count, part.split >= 0
        count[some] = totals.split_counts[part.split[some]]
        return per_batch(row, count[part.word], part.probabilities(own))

    kinds = "batch long, part int, texts binary, n_known binary, base_score binary, score binary"
    return with_replies(built.drop("names"), replies).groupBy("part").applyInArrow(scored, kinds)


_SUMS = ("batch", "part", "texts", "n_known", "base_score", "score")


def score_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from documents whose crc32 of the id's text modulo 5 is not 1. A null or empty text is
    one end token; a null id counts as the empty text. Repeated rows each count as training text and each
    get their score. An empty table gives an empty result. Other columns are not read.
    """
    who, built, common = deal_out(docs, id_col, text_col)
    totals, replies = fit(built, span_count(built.count()), len(common.words))

    def finish(rows: pa.Table) -> pa.Table:
        """The texts of one batch, with the sums of all parts in their order."""
        *sums, batch = sorted(rows.to_pylist(), key=lambda r: (r["part"] is None, r["part"]))
        n = batch["size"]
        text = np.concatenate([large(r["texts"]) for r in sums])
        add = lambda name, read: np.bincount(text, np.concatenate([read(r[name]) for r in sums]), minlength=n)
        train = np.frombuffer(batch["train"], bool)
        out = {
            "doc_id": pa.array(np.frombuffer(batch["ids"], np.int64), mask=np.frombuffer(batch["unknown"], bool)),
            "held_out": pa.array(~train),
            "n_tokens": pa.array(large(batch["length"])),
            "n_known": pa.array(add("n_known", large).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, totals.tokens, np.int64)),
            "base_score": pa.array(add("base_score", np.frombuffer)),
            "score": pa.array(add("score", np.frombuffer)),
        }
        return pa.table(out)

    rows = who.unionByName(text_sums(built, totals, replies, common), allowMissingColumns=True)
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("batch").applyInArrow(finish, kinds)
