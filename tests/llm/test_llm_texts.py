"""SimHash, line dedup, quality, token files and the piece lattice against brute force and on edge cases."""

import io
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from orbgrid.llm import components, line_dedup, piece_lattice, quality, simhash, token_store
from orbgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, fp string, root string, _row int, a string, h string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with names the operators use."""
    base = " ".join(f"word{k % 97}x{k}" for k in range(300))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, base), (6, base.upper()), (7, base + " tail"),
        (7, base + " tail"), (8, "other " * 60_000), (9, "é" * 70_000), (None, base), (10, "one two\n\none two"),
        (2, "different text under a used id"),
    ]
    return spark.createDataFrame([(*t, "c", "c", 1, "c", "c") for t in texts], DDL).repartition(3)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()


def groups_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


# -- components -------------------------------------------------------------------------------------


def test_components_of_paths_stars_and_nulls(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(7, 7), (None, 3)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = dict(components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    want = groups_of(400, [e for e in edges if None not in e])
    assert got == {k: r for k, r in enumerate(want) if k != r}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# -- SimHash ----------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_components_of_whole_table(spark):
    docs = documents(spark)
    fps = [plain_fingerprint(d.text) for d in docs]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    groups = groups_of(len(fps), links)
    got = {r.doc_id: r for r in QUERIES["op1_simhash_golay"](spark, SF).collect()}
    for k, d in enumerate(docs):
        assert got[d.doc_id].fingerprint == f"{fps[k]:016x}"
        assert got[d.doc_id].component_id == docs[groups[k]].doc_id


def test_links_share_a_golay_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 30_000).astype(np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    (ra, ka), (rb, kb) = simhash.link_keys(a), simhash.link_keys(b)
    shared = {r for r, _ in set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))}
    assert len(shared) == len(a)


def test_hot_buckets_are_sliced_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62)
    fps = {int(base) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(62))) for _ in range(300)} | {1, 3}
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 20)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.link_fingerprints(spark, df).collect()
    place = {f: k for k, f in enumerate(sorted(fps))}
    own = groups_of(len(fps), [(place[e.a], place[e.b]) for e in edges])
    wide = np.array(sorted(fps)).view(np.uint64)
    want = [(i, j) for i in range(len(fps)) for j in range(i) if int(wide[i] ^ wide[j]).bit_count() <= 4]
    assert own == groups_of(len(fps), want) and len(edges) < len(want)


def test_near_duplicates_on_odd_rows(spark, odd):
    out = simhash.near_duplicates(spark, odd)
    assert out.count() == odd.count()
    got = {(r.doc_id, r.fp): r.component_id for r in out.collect()}
    assert {c for (d, f), c in got.items() if f == 0} == {1}
    assert len({c for (d, _), c in got.items() if d in (5, 6)}) == 1
    kept = simhash.keep_one(spark, odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and ids.count(7) == 0 and ids.count(5) == 1 and ids.count(None) == 1
    assert simhash.keep_one(spark, odd.limit(0)).count() == 0


# -- lines ------------------------------------------------------------------------------------------


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain_distance(a, b)
        assert line_dedup.similar(a, b) == (plain_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def plain_simhash(line):
    """By the documented rule, a word at a time."""
    fps = []
    for word in set(line.encode().split()):
        h = sum((b + 1) * pow(line_dedup._ODD, k, 1 << 64) for k, b in enumerate(word)) & (1 << 64) - 1
        fps.append(int(line_dedup._mixed(np.array([h], np.uint64))[0]))
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in fps) > len(fps))


def plain_line_dedup(docs):
    first, seen = {}, []
    for d in docs:
        for n, line in enumerate((d.text or "").split("\n")):
            x = line_dedup.normalise(line)
            if len(x.split(" ")) >= line_dedup.MIN_WORDS:
                first.setdefault(x, (d.doc_id, n))
                seen.append((d.doc_id, n, x))
    lines = list(first)
    sims = np.array([plain_simhash(x) for x in lines], np.uint64)
    links = []
    for i in range(len(lines)):
        for j in np.flatnonzero(np.bitwise_count(sims[i] ^ sims[:i]) <= line_dedup.RADIUS):
            a, b = lines[i], lines[j]
            if plain_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                links.append((i, int(j)))
    group = dict(zip(lines, groups_of(len(lines), links)))
    stays = {}
    for x in lines:
        stays[group[x]] = min(stays.get(group[x], first[x]), first[x])
    gone = {(d, n) for d, n, x in seen if (d, n) != stays[group[x]]}
    return [
        (d.doc_id, "\n".join(x for n, x in enumerate((d.text or "").split("\n")) if (d.doc_id, n) not in gone)) for d in docs
    ], len(links)


def test_line_hashes_of_odd_texts():
    texts = ["", "\n", "A b  c, d; E\n\nfew words\na B c d e!", "é É ß 12 34 x x x", "\ta b c d e " + "w" * 3000, "1 " * 700]
    numbers, digests, sims = line_dedup.hash_lines(texts)
    lines = "\n".join(texts).split("\n")
    want = [k for k, x in enumerate(lines) if len(line_dedup.normalise(x).split()) >= 5]
    assert numbers.tolist() == want and digests[0] == digests[1]
    for n, d, s in zip(want, digests, sims):
        x = line_dedup.normalise(lines[n])
        assert d == xxhash.xxh3_128_digest(x.encode()) and int(s) & (1 << 64) - 1 == plain_simhash(x)
    assert line_dedup.hash_lines([""])[1] == []


def test_lines_of_whole_table(spark):
    want, links = plain_line_dedup(documents(spark))
    got = {r.doc_id: r.text_crc32 for r in QUERIES["op7_fuzzy_lines"](spark, SF).collect()}
    assert links and got == {d: zlib.crc32(t.encode()) for d, t in want}


def test_sliced_line_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP_LINES", 8)
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 0)
    words = [f"w{k}" for k in range(90)]
    rng = random.Random(6)
    rows = []
    for k in range(30):
        own = list(words)
        own[rng.randrange(90)] = f"changed{k}"
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, links = plain_line_dedup(df.orderBy("doc_id").collect())
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(spark, df).orderBy("doc_id").collect()]
    assert links and got == want


def test_lines_of_odd_rows(spark, odd):
    out = line_dedup.dedup_lines(spark, odd)
    rows = out.collect()
    assert out.columns == [*odd.columns, "n_lines", "n_removed"] and len(rows) == odd.count()
    by = {(r.doc_id, r.n_removed): r for r in rows}
    assert by[1, 0].text is None and by[2, 0].n_lines == 1 and by[10, 0].text == "one two\n\none two"
    # The null id comes first, so its copy of the line stays; the others lose it.
    assert by[None, 0].text and by[5, 1].text == "" and by[6, 1].text == ""
    left = line_dedup.without_repeats(spark, odd)
    assert left.columns == odd.columns and {5, 6}.isdisjoint({r.doc_id for r in left.collect()})
    assert line_dedup.without_repeats(spark, odd.limit(0)).count() == 0


def lines_left(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {r.doc_id for r in line_dedup.dedup_lines(spark, df).collect() if r.n_removed == 0}


@pytest.mark.parametrize("n", [5, 10, 20, 40, 100])
def test_lines_with_changed_words_are_found(spark, n):
    """One word in ten, or one, is another: recall against edit similarity alone."""
    rng = random.Random(n)

    def word():
        return "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))

    pairs = []
    while len(pairs) < 60:
        a = [word() for _ in range(n)]
        b = list(a)
        for k in rng.sample(range(n), max(1, n // 10)):
            b[k] = word()
        a, b = " ".join(a), " ".join(b)
        if plain_distance(a, b) <= 0.2 * max(len(a), len(b)):
            pairs += [(a, b)]
    left = lines_left(spark, [x for p in pairs for x in p])
    assert {2 * k for k in range(60)} <= left and sum(2 * k + 1 not in left for k in range(60)) >= 0.85 * 60


def test_band_keys_travel_in_blocks(monkeypatch):
    """A few rows for all keys of a batch of lines, and the same teams from them as from all pairs; hot runs come out whole."""
    rng = np.random.default_rng(5)
    sims = rng.integers(-(1 << 63), 1 << 63, 900)
    sims[600:] = sims[:300] ^ (1 << rng.integers(0, 63, 300))
    bands = rng.integers(0, 1 << 32, (900, line_dedup.BANDS)).astype(np.uint32)
    bands[600:, ::3] = bands[:300, ::3]
    bands[:40, 1] = 7
    batch = pa.RecordBatch.from_arrays([pa.array(sims), line_dedup._binaries(bands)], ["sim", "bands"])
    want = set()
    for band in range(line_dedup.BANDS):
        for i in range(900):
            for j in np.flatnonzero(bands[:i, band] == bands[i, band]):
                if np.bitwise_count((sims[i : i + 1] ^ sims[j]).view(np.uint64))[0] <= line_dedup.RADIUS and (band != 1 or bands[i, 1] != 7):
                    want.add((band, *sorted((int(sims[i]), int(sims[j])))))
    for parts, held in ((1, 1 << 22), (3, 1 << 22), (3, 50)):
        monkeypatch.setattr(line_dedup, "HELD_KEYS", held)
        blocks = [b for at in (0, 450) for b in line_dedup._blocks(parts)(iter([batch.slice(at, 450)]))]
        assert sum(b.num_rows for b in blocks) <= 2 * line_dedup.BANDS * parts
        rows = pa.Table.from_batches(blocks).sort_by("part")
        found = [r for b in line_dedup._met_in_blocks(parts, 20)(iter(rows.to_batches())) for r in b.to_pylist()]
        assert {(r["band"], *sorted(r["fps"])) for r in found if not r["hot"]} == want
        hot = [r for r in found if r["hot"]]
        assert {r["key"] for r in hot} == {1 << 32 | 7} and {x for r in hot for x in r["fps"]} == set(sims[:40].tolist())


def test_groups_of_lines_are_linked_as_by_pairs():
    """Many groups at once, small and large: connected as by comparing each pair by itself."""
    rng = random.Random(8)
    texts, group = [], []
    for g, size in enumerate([2, 3, 8, 9, 40, 2, 5, 17]):
        heads = [[f"{''.join(rng.choices('abcdé漢', k=rng.randint(2, 9)))}" for _ in range(rng.choice([5, 12, 60]))] for _ in range(2)]
        for _ in range(size):
            own = list(rng.choice(heads))
            for k in rng.sample(range(len(own)), rng.randint(0, len(own) // 3)):
                own[k] = "".join(rng.choices("abcdé漢", k=rng.randint(1, 9)))
            texts.append(" ".join(own))
            group.append(g)
    sims = np.zeros(len(texts), np.int64)
    links = [
        (i, j) for i in range(len(texts)) for j in range(i) if group[i] == group[j]
        and plain_distance(texts[i], texts[j]) <= 0.2 * max(len(texts[i]), len(texts[j])) + 1e-9
    ]
    a, b = line_dedup.link_groups(sims, texts, np.array(group))
    found = list(zip(a.tolist(), b.tolist()))
    assert links and {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in links}
    assert groups_of(len(texts), found) == groups_of(len(texts), links)


def test_lines_that_differ_in_digits_or_marks_stay(spark):
    lines = [
        "12 45 30 18 77", "99 81 26 64 13", "12 45 30 18 77", "a + b * c - d / e", "a=b;c(d){e}[]", "a & b | c ^ d % e",
        "Total of the day: 12 parts", "total of the day: 13 parts!",
    ]
    assert lines_left(spark, lines) == {0, 1, 3, 4, 5, 6}


# -- quality ----------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op9_quality_rff"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if r.doc_id in rows and rows[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert sum(r.predicted == q for r, q in held) >= 0.95 * len(held)
    assert all(r.predicted for r, q in held if q == 1)


def test_kernel_and_isotonic():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, len(quality.STATISTICS)))
    z = quality._fourier(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.WIDTH**2))
    assert np.abs(z @ z.T - exact).max() < 0.35 and np.abs(z @ z.T - exact).mean() < 0.08
    y = rng.random(50)
    fit = quality.isotonic(y, np.ones(50))
    assert (np.diff(fit) >= -1e-12).all() and abs(fit.sum() - y.sum()) < 1e-9


def test_quality_edges(spark, odd):
    stats = odd.select("doc_id", quality.statistics_of("text").alias("stats"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(stats, none)
    assert {r[0] for r in odd.select(model.score_text(F.col("text"))).collect()} == {0.5}
    some = spark.createDataFrame([(k, k % 2) for k in range(1, 9)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(stats, some)
    scores = [r[0] for r in odd.select(model.score_text(F.col("text"))).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert odd.limit(0).select(model.score_text(F.col("text"))).count() == 0


# -- token files ------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(texts, path=WORDS):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_token_files_of_whole_table(spark):
    docs, at = documents(spark), 0
    got = {r.doc_id: r for r in QUERIES["op8_token_planes"](spark, SF).collect()}
    for d, ids in zip(docs, whole_ids([d.text or "" for d in docs])):
        ids = [*ids, 2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_words_encode_as_in_whole_texts():
    rng = random.Random(7)
    parts = ["a", "B", "é", "é", "̈", " ", "\n", "\t", " ", "\xa0", "\x1c", "'s", "'ll", "<|endoftext|>", "12", "日",
             "!", "ß", "İ", "Σ", "ﬁ", "</w>", "😀", "µ", "Àz", ",", "the.", "²"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)]
    encoder = token_store.WordEncoder(WORDS)
    got = [np.frombuffer(x, "<u4").tolist() for x in token_store.encode_whole(encoder, texts)]
    assert encoder.by_word and got == whole_ids(texts)
    other = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_store.WordEncoder(other)
    got = [np.frombuffer(x, "<u4").tolist() for x in token_store.encode_whole(encoder, texts[:300])]
    assert not encoder.by_word and got == whole_ids(texts[:300], other)


def test_long_texts_and_full_memory(monkeypatch):
    monkeypatch.setattr(token_store, "PIECE_CHARS", 50)
    monkeypatch.setattr(token_store, "MEMO_WORDS", 20)
    texts = ["word " * 40 + f"tail{k}. " + "x" * 200 for k in range(30)] + ["", "one"]
    got = [np.frombuffer(x, "<u4").tolist() for x in token_store.encode_whole(token_store.WordEncoder(WORDS), texts)]
    assert got == whole_ids(texts)


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 100)
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, 2**32, n).astype("<u4") for n in (1, 0, 99, 350, 7)]
    data = token_store.encode_file([3, None, 4, 4, 5], [len(d) for d in docs], b"".join(d.tobytes() for d in docs), kind)
    file = token_store.TokenFile(Bytes(data))
    assert file.n_blocks == 5
    back = [(d, np.concatenate([*p, np.zeros(0, "<u4")])) for d, p in file.each_document()]
    assert [d for d, _ in back] == [3, None, 4, 4, 5] and all((a == b).all() for (_, a), b in zip(back, docs))
    assert (file.block(2) == np.concatenate(docs)[200:300]).all()
    with pytest.raises(ValueError):
        token_store.TokenFile(Bytes(data[:-1]))


def test_token_files_of_odd_rows(spark, odd):
    out = token_store.read_tokens(token_store.write_tokens(spark, odd, WORDS, 2), ids=True)
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10]
    assert all(r.start == sum(x.n_tokens for x in rows[:k]) and r.ids[-1] == 2 for k, r in enumerate(rows))
    assert rows[1].ids == [2]
    assert token_store.read_tokens(token_store.write_tokens(spark, odd.limit(0), WORDS, 2)).count() == 0


# -- pieces -----------------------------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return piece_lattice.PieceModel(MODEL)


def every_path(model, text, n):
    chunk = piece_lattice.SPACE + text.replace(" ", piece_lattice.SPACE)
    edges = model.edges(chunk)

    @lru_cache(None)
    def best(i):
        if i == len(chunk):
            return [(0.0, b"")]
        return sorted(((s + t, ids + rest) for j, s, ids in edges[i] for t, rest in best(j)), key=lambda x: -x[0])[:n]

    return best(0)


def test_nbest_against_all_paths(pieces):
    rng = random.Random(9)
    parts = [*"abethiosnr", "th", " ", "  ", "\n", "é", "日", "😀", "ing", "the ", ",", ".\n", "▁"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        got, want = pieces.nbest(text, 5), every_path(pieces, text, 5)
        assert [s for s, _ in got] == [s for s, _ in want], text
        assert len({ids for _, ids in got}) == len(got)
        assert {pieces.decode(ids) for _, ids in got} == {text.replace("▁", " ")}


def test_nbest_against_the_library(pieces):
    import sentencepiece

    raw = bytearray(open(MODEL, "rb").read())
    at = raw.rindex(b"\x18\x02", 0, raw.rindex(b"identity"))  # the model type: let the library take it as unigram
    raw[raw.rindex(b"tok_v0\x18\x02") + 7] = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))
    for text in ["hello world the", "the thing that other", "interesting words and more of them"]:
        want = library.nbest_encode_as_ids(text, 6)
        got = [np.frombuffer(ids, "<u4").tolist() for _, ids in pieces.nbest(text, 6)]
        score = [sum(library.get_score(k) for k in ids) for ids in got]
        assert score == [sum(library.get_score(k) for k in ids) for ids in want] and at


def test_pieces_of_whole_table(spark, pieces):
    got = {r.doc_id: r for r in QUERIES["op2_piece_nbest"](spark, SF).collect()}
    for d in documents(spark):
        r, text = got[d.doc_id], d.text or ""
        best, score = [0.0], 0.0
        chunk = piece_lattice.SPACE + text.replace(" ", piece_lattice.SPACE) if text else ""
        if text:
            best, ids, _ = pieces.viterbi(chunk)  # over the whole lattice at once
            score = best[-1]
            assert pieces.decode(ids) == text
        assert r.score == score == r.scores[0] and r.round_trip
        assert r.scores == sorted(r.scores, reverse=True) and len(set(r.crc32s)) == len(r.crc32s)


def test_pieces_of_odd_rows(spark, odd):
    out = piece_lattice.encode_pieces(odd, MODEL, 3)
    back = piece_lattice.decode_pieces(out, MODEL, to="back").collect()
    assert len(back) == odd.count() and all(r.round_trip for r in back)
    want = sorted((r.text or "") for r in odd.collect())
    assert sorted(r.back for r in back) == want
    assert [r.n_pieces for r in back if r.doc_id == 1] == [0]
    assert piece_lattice.encode_pieces(odd.limit(0), MODEL).count() == 0
