"""The corpus operators against brute force on small tables with nulls, ties, copies and clashing columns."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import forest, language_model, line_dedup, mixing, near_vectors, ngram_join, packing, quality, sharding, token_files, tokens
from tidemark.llm.common import key_groups, table
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
LINE = "a line of more than twenty characters"
BASE = " ".join(f"w{k}" for k in range(60))
TEXTS = [
    (1, BASE, "a"),
    (2, BASE + " tail", "a"),
    (3, BASE.replace("w30", "other"), "b"),
    (4, BASE.upper(), None),
    (5, None, "b"),
    (6, "", None),
    (7, "two words", "a"),
    (8, "Two  WORDS", "b"),
    (9, f"x\n{LINE}\ny", "c"),
    (10, f" {LINE.upper()}\t\nz", "c"),
    (11, f"{LINE}\n{LINE}", "c"),
    (12, "long " * 6000 + "<|endoftext|>  end\n\n\nhere", "a"),
    (None, f"q\n{LINE}", "a"),
    (7, "two words", "a"),
]
CLASHES = "shard int, size int, node int, row int, key int, n int, source_size int, h int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, s, *range(8)) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {CLASHES}").repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("1 = 0")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_shards_move_only_into_the_new_one(docs, nothing):
    got = sharding.assign_shards(docs, "doc_id", "text").collect()
    assert len(got) == len(TEXTS)
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    want = sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in TEXTS)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == want
    assert sharding.assign_shards(nothing, "doc_id", "text").count() == 0


def test_jump_hash_moves_a_fair_share():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    for n in (1, 2, 8, 100):
        a, b = sharding.jump_hash(keys.copy(), n), sharding.jump_hash(keys.copy(), n + 1)
        assert set(np.unique(b[a != b])) <= {n} and abs((a != b).mean() - 1 / (n + 1)) < 0.02


def test_mix_meets_targets(docs, nothing):
    got = mixing.mix(docs, "doc_id", "text", "source").collect()
    assert len(got) == len(TEXTS) and all(r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size for r in got)
    total = sum(len(words(t)) for _, t, _ in TEXTS)
    assert abs(sum(target for _, target in {(r.source_size, r.target) for r in got}) - total) < 1e-6 * total
    assert sum(r.taken for r in got) <= total
    again = mixing.mix(docs.repartition(5), "doc_id", "text", "source").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix(nothing, "doc_id", "text", "source").count() == 0
    mixed = mixing.mixed_documents(docs, "doc_id", "text", "source")
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r.size for r in got if r.size)


def brute_lines(texts):
    holders = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    rank = lambda i: -1 if i is None else i
    for i, t, _ in texts:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, t, _ in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == rank(i)]
        out.append((rank(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_line_dedup_equals_brute_force(docs, nothing):
    got = line_dedup.line_report(docs, "doc_id", "text").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute_lines(TEXTS)
    assert line_dedup.line_report(nothing, "doc_id", "text").count() == 0
    assert line_dedup.drop_lines(docs, "doc_id", "text").columns == docs.columns


def test_one_line_over_many_ranges(spark):
    texts = [(i, f"{LINE}\nown line number {i} of this text", "s") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(7)
    got = line_dedup.line_report(docs, "doc_id", "text").collect()
    assert sorted(tuple(r) for r in got) == brute_lines(texts)


def test_quality_space_is_fitted_block_by_block(monkeypatch):
    rng = np.random.default_rng(3)
    owner, term = np.nonzero(rng.random((600, quality.WORD_TERMS + quality.SHAPE_TERMS)) < 0.05)
    counts = owner, term, rng.integers(1, 4, len(term)), np.bincount(owner, minlength=600)
    held, weigh = [], quality.weighted
    monkeypatch.setattr(quality, "weighted", lambda some, idf: (held.append(len(some[3])), weigh(some, idf))[1])
    space = quality.LatentSpace(counts, rng.integers(0, 2, 600))
    assert max(held) <= 256 and space.known.shape == (600, quality.DIMENSIONS)
    dense = np.zeros((600, quality.WORD_TERMS + quality.SHAPE_TERMS))
    dense[owner, term] = weigh(counts, space.idf)
    dense -= dense.mean(axis=0)
    most = np.linalg.svd(dense, compute_uv=False)[: quality.DIMENSIONS]
    assert np.linalg.norm(dense @ space.axes) >= 0.99 * np.linalg.norm(most)


def test_ngram_components_equal_brute_force(docs, nothing):
    sets = [(i, frozenset(zip(*[words(t)[k:] for k in range(5)], strict=False)) if len(words(t)) >= 5 else frozenset([tuple(words(t))] if words(t) else [])) for i, t, _ in TEXTS]
    root = {i: i for i, _ in sets if i is not None}
    for _ in sets:
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = ngram_join.join_components(docs, "doc_id", "text").collect()
    key = lambda x: -1 if x is None else x
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == sorted((key(i), len(s), key(root.get(i))) for i, s in sets)
    assert ngram_join.join_components(nothing, "doc_id", "text").count() == 0
    kept = ngram_join.keep_first(docs, "doc_id", "text")
    assert kept.columns == docs.columns and sorted(key(r.doc_id) for r in kept.collect()) == sorted(key(i) for i, _ in sets if root.get(i) == i or i is None)


def test_ngram_join_of_a_large_group(spark):
    rng = np.random.default_rng(5)
    base = [f"g{k}" for k in range(80)]
    texts = []
    for i in range(150):
        mine = list(base)
        mine[int(rng.integers(80))] = f"e{i}"
        texts.append((i, " ".join(mine)))
    texts += [(i, " ".join(f"u{i}x{k}" for k in range(50))) for i in range(150, 200)]
    got = ngram_join.join_components(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 0 if i < 150 else i for i, _ in texts}


def test_ngram_copies_of_one_original_meet_it_first(spark, monkeypatch):
    """Copies too far from each other are linked by the original: pairs grow with the copies, not with their square."""
    rng = np.random.default_rng(6)
    texts = {0: " ".join(f"g{k}" for k in range(120))}
    for i in range(1, 121):
        mine = texts[0].split(" ")
        at, size = int(rng.integers(15, 85)), int(rng.integers(1, 22))
        mine[at : at + size] = [f"e{i}x{k}" for k in range(size)]
        texts[i] = " ".join(mine)
    pairs, compare = [], ngram_join.verified

    def counted(found, texts):
        pairs.append(found.count())
        return compare(found, texts)

    monkeypatch.setattr(ngram_join, "verified", counted)
    got = ngram_join.join_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(texts)
    assert sum(pairs) <= 3 * len(texts)


def linked(texts):
    """Each id's set size and smallest reachable id; pairs are counted shingle by shingle."""
    sets, holders, shared, root = {}, {}, {}, {i: i for i in texts}
    for i, text in texts.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        for x in sets[i]:
            for j in holders.setdefault(x, []):
                shared[j, i] = shared.get((j, i), 0) + 1
            holders[x].append(i)
    top = lambda i: i if root[i] == i else top(root[i])
    for (i, j), n in shared.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return sorted((i, len(sets[i]), top(i)) for i in texts)


def test_ngram_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    got = QUERIES["op2_ngram_join"](spark, folder).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(texts)


@pytest.mark.parametrize(("crowd", "chunk", "carried"), [(2, 1024, 256), (6, 3, 1), (14, 3, 2), (14, 1024, 256)])
def test_ngram_pairs_of_crowded_tokens_come_last(spark, monkeypatch, crowd, chunk, carried):
    for name, value in (("CROWD", crowd), ("CHUNK", chunk), ("CARRIED", carried), ("STAR_ROUNDS", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(12)
    passages = [" ".join(f"p{k}x{m}" for m in range(12)) for k in range(14)]
    texts = {i: " ".join(passages[k] for k in sorted(rng.choice(14, int(rng.integers(3, 12)), replace=False))) for i in range(60)}
    got = ngram_join.join_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(texts)


@pytest.mark.parametrize(("chunk", "carried"), [(1024, 256), (3, 256), (3, 1), (1024, 2)])
def test_ngram_pairs_in_chunks_and_blocks(spark, monkeypatch, chunk, carried):
    """Texts of shared passages in changing order: many tokens for a node, components within a token."""
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "CARRIED", carried)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    rng = np.random.default_rng(11)
    passages = [" ".join(f"p{k}x{m}" for m in range(12)) for k in range(14)]
    texts = {i: " ".join(passages[k] for k in sorted(rng.choice(14, int(rng.integers(3, 12)), replace=False))) for i in range(60)}
    got = ngram_join.join_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text").collect()
    want = linked(texts)
    assert len({r for _, _, r in want}) < len(texts)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_groups_span_batches():
    keys = [0, 0, 1, 2, 2, 2, 2, 2, 3, 3, 4, 5]
    whole = pa.RecordBatch.from_pydict({"k": pa.array(keys), "at": pa.array(range(len(keys)))})
    for size in (1, 2, 3, 5, 12):
        batches = [whole.slice(0, 0), *(whole.slice(a, size) for a in range(0, len(keys), size))]
        groups = [g.column("at").to_pylist() for g in key_groups(iter(batches), ["k"])]
        assert groups == [[0, 1], [2], [3, 4, 5, 6, 7], [8, 9], [10], [11]]


@pytest.mark.parametrize(("name", "keeps_space"), [(tokens.BYTE_BPE, True), (tokens.WORD_BPE, False)])
def test_ids_equal_the_library(name, keeps_space):
    path = public_tokenizers.path(name)
    texts = [t or "" for _, t, _ in TEXTS] + ["a  b", " a ", "\n\nb \n", "a\tb \tc\n d", "don't we'll", "é́ İ", "a\xa0b 　c", "\x1c x\x1cy"]
    plain = Tokenizer.from_file(path)
    encoder = tokens.Encoder(path, keeps_space, memo_words=3)
    for _ in range(2):
        got = encoder.ids(texts)
        assert [np.frombuffer(x, np.uint32).tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize(("name", "keeps_space"), [(tokens.BYTE_BPE, True), (tokens.WORD_BPE, False)])
def test_ids_of_random_text_equal_the_library(name, keeps_space):
    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path, keeps_space)
    rng = random.Random(1)
    units = [*"\0ab1'.  \n\n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u3000\u200b\u0301é中\U0001f600", "<|endoftext|>", "<|startoftext|>", "'s", " the", "\n"]
    for _ in range(20):
        texts = ["".join(rng.choice(units) for _ in range(rng.randrange(25))) for _ in range(200)]
        assert [np.frombuffer(x, np.uint32).tolist() for x in encoder.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    long = " ".join(rng.choice(["ab", "İx", "12", "q\n\nr", "don't"]) for _ in range(1_300_000))  # above 4 MB
    got = encoder.ids(pa.array([None, "x", long, "y z"]).slice(1))
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in ("x", long, "y z")]
    assert encoder.ids([]) == [] and encoder.ids(["", ""]) == [b"", b""]


def test_new_words_cost_the_library_no_marks(monkeypatch):
    """Words in capitals, at line ends or before a sign are known; new ones are encoded without marks between them."""
    path = public_tokenizers.path(tokens.WORD_BPE)
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path, False)
    made, encode = [], encoder.encode
    monkeypatch.setattr(encoder, "encode", lambda text: made.append(encode(text)) or made[-1])
    words = [f"q{chr(97 + k % 26)}{chr(97 + k // 26)}zu" for k in range(600)]
    texts = [" ".join(words), "\n".join(w.title() for w in words), " ".join(w + "," for w in words), " ".join(w + "?" for w in words)]
    got = encoder.ids(texts)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == want
    assert sum(map(len, made)) <= len(want[0]) + 40


def test_cuts_within_words_leave_ids_alone():
    path = public_tokenizers.path(tokens.WORD_BPE)
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path, False)
    rng = np.random.default_rng(4)
    bits = ["a", "B", "re", "Ve", "s", "S", "'", "'s", "\u2019", "7", "42", ".", ",", "<", "|", ">", "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "</w>", "\0", "\t", "\r", "\x1c", " ", "  ", "\n", "\u00a0",
            "\u0301", "\u0338", "=", "\u00e9", "\u0130", "\u03a3", "\u212a", "\u4e2d", "\u0664", "\U0001f600", "_", "-"]
    texts = ["".join(rng.choice(bits, n)) for n in rng.integers(0, 40, 3000)]
    for a in (texts[:1], texts[1:2], texts, [t.replace("<|", "") for t in texts]):
        assert [np.frombuffer(x, np.uint32).tolist() for x in encoder.ids(a)] == [plain.encode(t, add_special_tokens=False).ids for t in a]


def document_ids(name):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)) for i, t, _ in TEXTS]


def test_packing_places_every_id_once(docs, nothing):
    got = packing.pack(docs, "doc_id", "text", public_tokenizers.path(tokens.BYTE_BPE), with_ids=True)
    rows = got.collect()
    want = sorted((-1 if i is None else i, a, zlib.crc32(ids[a : a + 2048].tobytes())) for i, ids in document_ids(tokens.BYTE_BPE) for a in range(0, len(ids), 2048))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.ids_crc32) for r in rows) == want
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert {len(r.ids) for r in packing.sequences(got).collect()} <= {8192, *(4 << k for k in range(11))}
    assert packing.pack(nothing, "doc_id", "text", public_tokenizers.path(tokens.BYTE_BPE)).count() == 0


def test_window_plan_uses_every_length():
    rng = np.random.default_rng(2)
    counts = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 2049, 3000), return_counts=True), strict=True)}
    plan = packing.plan_windows(counts, 2048)
    assert {k: sum(n for length, _, n, *_ in plan if length == k) for k in counts} == counts
    windows = 1 + max(first + n // m - 1 for _, _, n, m, first, _ in plan)
    least = max(sum(k * n for k, n in counts.items()) / 2048, sum(n for k, n in counts.items() if k > 1024))
    assert windows <= 1.01 * least
    small = {k: 7 for k in range(3, 700)}
    plan = packing.plan_windows(small, 2048)
    windows = 1 + max(first + n // m - 1 for _, _, n, m, first, _ in plan)
    assert windows <= sum(7 * k for k in small) / 2048 + 2
    assert packing.closest_multiset({7: 1, 5: 3, 4: 1}, 16) == {7: 1, 5: 1, 4: 1}


def test_token_files_round_trip(spark, docs, nothing, tmp_path):
    path = public_tokenizers.path(tokens.WORD_BPE)
    manifest = token_files.write_token_files(docs, "doc_id", "text", path, str(tmp_path))
    got = sorted(token_files.read_token_files(manifest, str(tmp_path)).collect(), key=lambda r: r.start)
    ids = document_ids(tokens.WORD_BPE)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ids), key=lambda i: -1 if i is None else i)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((-1 if i is None else i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    files, folder = token_files.open_folder(str(tmp_path))
    for row in manifest.collect():
        one = token_files.TokenFile(files, f"{folder}/{row.file}")
        for k, (_, start, whole) in enumerate(one.documents()):
            assert one.document(k).tolist() == whole.tolist() and start == (one.ends.value(k - 1) if k else 0)
    assert token_files.token_report(nothing, "doc_id", "text", path).count() == 0


def test_token_files_are_read_by_select(docs, tmp_path, monkeypatch):
    manifest = token_files.write_token_files(docs, "doc_id", "text", public_tokenizers.path(tokens.WORD_BPE), str(tmp_path))
    files, folder = token_files.open_folder(str(tmp_path))
    names = [row.file for row in manifest.collect()]
    read = lambda: [(i, start, ids.tolist()) for name in names for i, start, ids in token_files.TokenFile(files, f"{folder}/{name}").documents()]

    def whole(self):
        raise AssertionError("all values are decoded at once")

    monkeypatch.setattr(EliasFano, "values", whole)
    want = read()
    assert len(want) == len(TEXTS)
    for name, value in (("BLOCK_DOCS", 2), ("READ_BYTES", 16)):
        monkeypatch.setattr(token_files, name, value)
        assert read() == want


def test_elias_fano_selects_every_value():
    rng = np.random.default_rng(3)
    for values in ([], [0], [5, 5, 5], [-(2**62), 0, 2**62], np.sort(rng.integers(0, 10**9, 3000)), np.arange(700)):
        coded = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.int64)).to_bytes())
        assert coded.values().tolist() == list(values) and [coded.value(i) for i in range(0, len(values), 7)] == list(values)[::7]
    dense = EliasFano.encode(np.cumsum(rng.integers(1, 1000, 10_000)))
    assert len(dense.to_bytes()) * 8 < 12 * 10_000
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1]))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((240, 16))
    x[100:140] = x[100] + 0.05 * rng.standard_normal((40, 16))
    x[140:150] = x[0]
    rows = [(k * 2, v.tolist(), None if k % 50 == 3 else k % 2 * (k < 100)) for k, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0]]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(None, x[0].tolist(), 0), rows[0]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS v", "2 AS size"), x


def test_near_vectors_equal_brute_force(vectors):
    table, x = vectors
    got = {r.vec_id: r for r in near_vectors.near_vectors(table, "vec_id", "embedding", "label").collect()}
    label = np.array([-k - 1 if k % 50 == 3 else k % 2 * (k < 100) for k in range(240)])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    for k in range(240):
        assert got[2 * k].n_links == link[k].sum()
    assert got[202].component_id == 200 and got[2 * 145].component_id == 0 and got[0].kept and not got[202].kept
    assert all(got[1000 + k].n_links == 0 and got[1000 + k].kept for k in range(7)) and len(got) == 248
    assert near_vectors.near_vectors(table.where("1 = 0"), "vec_id", "embedding", "label").count() == 0


def test_forest_finds_neighbours(vectors):
    table, x = vectors
    got = forest.nearest(table, "vec_id", "embedding", k=5).collect()
    assert {r.query_id for r in got} == set(range(0, 480, 20))
    for q in range(0, 480, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        score = (x * x[q // 2]).sum(axis=1)
        want = sorted((k for k in range(240) if 2 * k != q), key=lambda k: (-score[k], k))[:5]
        assert [r.vec_id // 2 for r in mine] == want and [r.rank for r in mine] == [1, 2, 3, 4, 5]
    assert forest.nearest(table.where("1 = 0"), "vec_id", "embedding").count() == 0


def test_ngram_join_deals_prefixes_out_once(spark, monkeypatch):
    """Shingles of several nodes come of one shuffle, whatever batches their rows fall into."""
    rng = np.random.default_rng(8)
    sets = [(int(rng.integers(60)), [int(t) for t in rng.choice(4000, 12, replace=False) if t % 40 or t < 400]) for _ in range(300)]
    sets += [(k, [5000]) for k in range(50)] + [(7, [6000])] * 30
    usable, plans, write = spark.createDataFrame(sets, "node long, prefix array<long>").repartition(5), [], ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    nodes = {}
    for node, prefix in sets:
        for token in prefix:
            nodes.setdefault(token, set()).add(node)
    want = sorted((t, n) for t, held in nodes.items() if len(held) > 1 for n in held)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "7", before):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert sorted(map(tuple, ngram_join.met_tokens(usable).collect())) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(plans) == 3 and all(p.count("Exchange hashpartitioning(token") == 1 for p in plans)


def test_language_model_counts_and_improves(spark, docs, nothing):
    got = language_model.score_texts(docs, "doc_id", "text").collect()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5
    known = [w for i, t, _ in TEXTS if fold(i) != 1 for w in [*words(t), None]]
    counts = {w: known.count(w) for w in set(known)}
    want = []
    for i, t, _ in TEXTS:
        mine = [*words(t), None]
        base = sum(np.log10((counts.get(w, 0) + 0.5) / (len(known) + 0.5 * (len(counts) + 1))) for w in mine)
        want.append((-1 if i is None else i, fold(i) == 1, len(mine), sum(w in counts for w in mine), len(known), round(base, 6)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got) and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert language_model.score_texts(nothing, "doc_id", "text").count() == 0


def test_language_model_probabilities_sum_to_one():
    row = {"part": 0, "entries": [3, 2, 1], "contexts": [0, 1, 2, 0, 1, 2], "customers": [5, 0, 9, 2, 1, 1]}
    row |= {k: np.array(row[k], np.uint32).tobytes() for k in ("entries", "contexts", "customers")}
    part = language_model.Part(row)
    totals = language_model.Totals(18, 3, 0.6, 0.4, np.array([7, 1, 10]))
    for _ in range(4):
        tables, in_root, root_tables = part.last_sweep(totals)
        assert (tables <= part.customers).all() and ((tables > 0) == (part.customers > 0)).all()
        totals.tables.append(np.bincount(part.context, tables, minlength=3).astype(int))
        totals.root_customers.append(int(in_root.sum()))
        totals.root_tables.append(int(root_tables.sum()))
    p = part.root_probability(totals, 3, in_root, root_tables)
    unknown = (language_model.ROOT_STRENGTH + 0.4 * totals.root_tables[3]) / 4 / (language_model.ROOT_STRENGTH + totals.root_customers[3])
    assert abs(p.sum() + unknown - 1) < 1e-9


def test_language_model_keeps_every_context_apart(spark):
    # 2 ** 18 + 200 contexts, each followed by one word of its own: no two share a restaurant
    n = (1 << 18) + 200
    texts = [(i, " ".join(f"c{k}" for k in range(a, min(n, a + 5000)))) for i, a in zip((k for k in range(10**6) if zlib.crc32(str(k).encode()) % 5 != 1), range(0, n, 5000), strict=False)]
    built = language_model.deal_out(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")[1]
    _, replies = language_model.fit(built, 8)
    held = {}
    for row in replies[0].where("n >= 0").collect():
        held.setdefault((row.span, row.part, row.n), language_model.large(row.x))
    places = {(r.span, r.part): language_model.large(r.x) for r in replies[0].where("n = -1").collect()}
    customers = {(span, int(p)): int(x) for (span, part), at in places.items() for p, x in zip(at, held[span, part, 0], strict=True)}
    assert len(customers) == n + 1  # and the start of a text
    assert sum(customers.values()) == n + len(texts) and max(customers.values()) == len(texts)
    assert sorted(customers.values())[-2] == 1


def test_language_model_splits_one_word_over_parts(spark, monkeypatch):
    # a third of all tokens is one word, a ninth one pair of it with itself
    rng = np.random.default_rng(6)
    texts = [(i, " ".join(np.where(rng.random(400) < 1 / 3, "hot", rng.choice([f"v{k}" for k in range(300)], 400)))) for i in range(300)]
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    _, built, common = language_model.deal_out(table, "doc_id", "text")
    held = [int(language_model.large(r.tokens).sum()) for r in built.collect()]
    assert sum(held) == 300 * 401 and max(held) < 4 * sum(held) / len(held)
    assert len(common.pair_words) and built.where("entries IS NULL").count()
    split = {r.doc_id: r for r in language_model.score_texts(table, "doc_id", "text").collect()}
    empty = np.zeros(0, np.uint64)
    monkeypatch.setattr(language_model, "frequent", lambda texts, n_parts: language_model.Frequent(empty, empty, empty))
    for r in language_model.score_texts(table, "doc_id", "text").collect():
        s = split[r.doc_id]
        assert (s.n_tokens, s.n_known, s.train_tokens, round(s.base_score, 6)) == (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        assert abs(s.score - r.score) < 0.02 * abs(r.score)


def test_language_model_rows_follow_the_text_not_the_partitions(spark, monkeypatch):
    """Parts, messages and sums are as many for 3 shuffle partitions as for 60; sums come by batch, not by text."""
    monkeypatch.setattr(language_model, "PACKED_TOKENS", 2000)
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"v{k}" for k in rng.zipf(1.3, 60) % 5000)) for i in range(400)]
    table, made, before = spark.createDataFrame(texts, "doc_id long, text string").repartition(4), [], spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        who, built, common = language_model.deal_out(table, "doc_id", "text")
        totals, replies = language_model.fit(built, language_model.span_count(built.count()), len(common.words))
        sums = language_model.text_sums(built, totals, replies, common)
        made.append((who.count(), built.count(), replies[0].count(), sums.count()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made[0] == made[1] and made[0][3] <= made[0][0] * made[0][1] < 400


def test_language_model_totals_are_those_of_all_parts():
    names = {0: np.array([3, 7, 2**63 + 1], np.uint64), 1: np.array([7, 2**63 + 1, 2**63 + 2], np.uint64)}
    counts = {0: np.array([5, 1, 300]), 1: np.array([2, 0, 70_000])}
    sent = []
    for k in names:
        row = {"part": k, "entries": [3], "contexts": [0, 1, 2], "customers": [1, 1, 1]}
        part = language_model.Part(row | {c: np.array(row[c], np.uint32).tobytes() for c in ("entries", "contexts", "customers")})
        sent += language_model.messages(part, language_model.ranged(names[k], 1), {-2: names[k], 0: counts[k]}, [k + 4], np.zeros(0, int)).to_pylist()
    table = lambda rows: pa.Table.from_pylist(rows, pa.schema([("span", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("x", pa.binary()), ("number", pa.int64())]))
    out = language_model.add_up(table([r for r in sent if r["span"] == 0])).to_pylist()
    got = {(r["part"], r["n"]): language_model.large(r["x"]).tolist() for r in out}
    assert got == {(0, -1): [0, 1, 2], (1, -1): [1, 2, 3], (0, 0): [5, 3, 300], (1, 0): [3, 300, 70_000]}
    assert language_model.add_up(table([r for r in sent if r["span"] < 0])).to_pylist()[0]["number"] == 9


def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(i, q) for i, q in labels if got[i].held_out]
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([got[i].predicted == q for i, q in held]) > 0.95


def test_quality_without_labels_or_text(docs, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none, "doc_id", "text", "quality"), "doc_id", "text").collect()} == {0.5}
    few = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    space = quality.fit(docs, few, "doc_id", "text", "quality")
    assert quality.score(docs, space, "doc_id", "text").count() == len(TEXTS)
    assert quality.score(nothing, space, "doc_id", "text").count() == 0
    assert quality.keep_good(docs, space, "text").columns == docs.columns


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    got, want = QUERIES[name](spark, FOLDER).toArrow(), con.sql(ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    rows = lambda t: sorted(map(repr, zip(*[t.column(c).to_pylist() for c in columns], strict=True)))
    assert sorted(got.column_names) == columns and rows(got) == rows(want)
