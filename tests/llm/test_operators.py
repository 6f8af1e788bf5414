"""The operators against plain versions, on the given tables and on made texts."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from callmill.llm import (
    decontam,
    license_scan,
    line_chunks,
    line_quality,
    order_minhash,
    packing,
    queries,
    sharding,
    suffix_dedup,
    token_count,
    toxicity,
)
from tests.compare import oracle_rows, spark_rows
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, source="a"):
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    columns, rows, _ = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected_columns, expected, _ = oracle_rows(queries.ORACLES[name], SF_DIR)
    assert (columns, rows) == (expected_columns, expected)


# --- op1 ---


def mixed_texts(seed=1):
    r = random.Random(seed)
    rnd = lambda n, of="abcdé ": "".join(r.choice(of) for _ in range(n))
    base = rnd(700)
    texts = ["", "a" * 1000, "ab" * 700, None, "a" * 99, "a" * 100, base, base[100:400] + rnd(50) + base[350:]]
    texts += [rnd(90) * 5, base, ("xyz " * 30 + rnd(40)) * 4]
    return texts + [rnd(60) + base[200:420] + rnd(60) for _ in range(30)]


def removed_bytes(spark, docs):
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    return sorted((tuple(r)[:5] for r in got.collect()), key=lambda r: (brute.order(r[0]), r[1:]))


def test_repeated_bytes_of_the_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    docs = [tuple(r) for r in rows]
    assert removed_bytes(spark, docs) == brute.repeated_bytes(docs)


@pytest.mark.parametrize("settings", [{}, {"HOT": 10}, {"HOT": 10, "REMEMBERED": 3}, {"SHARD_SEGMENTS": 2, "BUCKET_SEGMENTS": 16}])
def test_repeated_bytes_of_hot_and_periodic_texts(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = [*enumerate(mixed_texts()), (None, mixed_texts()[6][:300])]
    assert removed_bytes(spark, docs) == brute.repeated_bytes(docs)


@pytest.mark.parametrize("per_shard", [1, 2, 5, 1000])
def test_merged_transforms(monkeypatch, per_shard):
    """Windows that also start at a lesser key, by interleaving shards of any size."""
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", per_shard)
    r = random.Random(per_shard)
    for _ in range(15):
        base = bytes(r.randrange(3) for _ in range(400))
        segments = {}
        for _ in range(r.randint(1, 25)):
            a = r.randrange(0, 250)
            s = bytearray(base[a : a + r.randint(100, 150)])
            if r.random() < 0.5:
                s[r.randrange(len(s))] = 9
            segments.setdefault(bytes(s), None)
        segments = [s for s in segments if len(s) >= 100]
        starts = r.sample(range(1000), len(segments))
        rows = [(s, 1, 0, 1000 * at) for s, at in zip(segments, starts)]
        first = {}
        for s, _, _, at in rows:
            for i in range(len(s) - 99):
                first[s[i : i + 100]] = min(first.get(s[i : i + 100], 1 << 60), at + i)
        expected = {at + i + k for s, _, _, at in rows for i in range(len(s) - 99) if first[s[i : i + 100]] < at + i for k in range(100)}
        got = {p for _, _, a, b in suffix_dedup._spans_of(rows) for p in range(a, b)} if rows else set()
        assert got == expected


def test_runs_hold_no_equal_windows_around_4096(spark):
    r = random.Random(5)
    for before in (1, 30, 50, 60, 76, 77, 100, 150):
        for length in (150, 4096):
            noise = [bytes(r.randrange(97, 123) for _ in range(n)) for n in (4096 * 2 - before, 300)]
            text = noise[0] + b"=" * length + noise[1]
            for start, size, _ in zip(*suffix_dedup.runs(text)):
                windows = [text[i : i + 100] for i in range(start, start + size)]
                assert len(set(windows)) == len(windows)


def test_periodic_bytes_around_4096(spark):
    r = random.Random(6)
    noise = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (4096 - 60, 300)]
    text = noise[0] + "=" * 150 + noise[1]
    got = suffix_dedup.suffix_dedup(frame(spark, [text])).collect()
    assert [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got] == brute.repeated_bytes([(0, text)])
    assert got[0].n_removed > 100


# --- op2 ---


def spark_hash(*values):
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def plain_chunks(text):
    """(first line, end) of each chunk."""
    lines = text.split("\n")
    n, h = len(lines), [spark_hash(x) for x in lines]
    mark = lambda i: spark_hash(h[i - 1] if i else None, h[i])
    starts = [0] + [i + 1 for i in range(1, n - 2) if mark(i) < mark(i - 1) and mark(i) <= mark(i + 1)]
    return list(zip(starts, [*starts[1:], n]))


def plain_passages(lines):
    """The shortest runs of lines of over 50 words that start or end at a line."""
    c, out = [len(x.split()) for x in lines], set()
    for i in range(len(lines)):
        for step in (1, -1):
            j, words = i, 0
            while 0 <= j < len(lines) and words <= 50:
                words, j = words + c[j], j + step
            if words > 50 and c[i]:
                out.add((i, j) if step > 0 else (j + 1, i + 1))
    return sorted(out)


def plain_removals(docs):
    """{doc: (lines, removed chunks, numbers of the removed lines, what is left)} of different ids."""
    chunks, passages, out = {}, {}, {}
    for doc, text in sorted(docs, key=lambda d: (d[0], spark_hash(d[1] or ""))):
        lines, gone, n = (text or "").split("\n"), set(), 0
        for a, b in plain_chunks(text or ""):
            part = "\n".join(lines[a:b])
            if b - a >= 2 and part.strip() and chunks.setdefault(part, (doc, a)) != (doc, a):
                gone.update(range(a, b))
                n += 1
        for a, b in plain_passages(lines):
            d, _, end = passages.setdefault("\n".join(lines[a:b]), (doc, a, b))
            if d != doc or end <= a:
                gone.update(range(a, b))
        out[doc] = (len(lines), n, gone, "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def check_removals(rows, docs):
    expected = {
        doc: (n, chunks, len(gone), hashlib.md5(left.encode()).hexdigest())
        for doc, (n, chunks, gone, left) in plain_removals(docs).items()
    }
    assert {r.doc_id: (r.n_lines, r.n_removed_chunks, r.n_removed_lines, r.kept_md5) for r in rows} == expected
    return expected


def test_line_chunks(spark, documents):
    expected = check_removals(queries.op2_line_dedup(spark, SF_DIR).collect(), documents)
    assert sum(v[1] for v in expected.values()) > 50


def test_lines_whose_hashes_clash(spark, monkeypatch):
    """Bytes decide: with a hash that many lines share, only equal lines go."""
    weak = lambda line: F.when(line.startswith("same"), F.xxhash64(line)).otherwise(F.length(line).cast("long"))
    r = random.Random(9)
    line = lambda k: " ".join(f"{k}{r.randrange(10)}" for _ in range(26))
    twice = [f"same {line('x')}" for _ in range(3)]
    texts = ["\n".join([*[line("a") for _ in range(3)], *twice, *[line("b") for _ in range(3)]]) for _ in range(8)]
    monkeypatch.setattr(line_chunks, "_line_hash", weak)
    left = {x.doc_id: x.text for x in line_chunks.drop_repeated_chunks(frame(spark, texts)).collect()}
    own = ["\n".join(x for x in t.split("\n") if not x.startswith("same")) for t in texts]
    assert left == {i: t if i == 0 else own[i] for i, t in enumerate(texts)}


def test_chunks_resist_shifts(spark):
    r = random.Random(3)
    lines = [f"line {r.random()}" for _ in range(40)]
    texts = ["\n".join(lines), "\n".join(["new first line", *lines]), "\n".join(["a", "b", "c", *lines[7:]])]
    removed = {x.doc_id: x.n_removed_lines for x in line_chunks.line_dedup(frame(spark, texts)).collect()}
    assert removed[0] == 0 and removed[1] >= 34 and removed[2] >= 26


def test_documents_of_repeated_chunks_alone_go(spark):
    text = "\n".join(f"line {i}" for i in range(30))
    docs = frame(spark, [text, text, text + "\nown end", "single line", "single line", None, ""])
    left = {r.doc_id: r for r in line_chunks.drop_repeated_chunks(docs).collect()}
    assert sorted(left) == [0, 2, 3, 4, 5, 6]
    assert left[0].text == text and left[2].text.endswith("own end") and left[2].n_chars == len(left[2].text) < len(text)
    assert left[5].text is None


@pytest.mark.parametrize("n_lines", range(1, 7))
def test_planted_passages_go_whole(spark, n_lines):
    """Passages of 51 words and more in unrelated surroundings, with lines of unequal lengths."""
    r = random.Random(n_lines)
    line = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    around = lambda: [line(r.randint(1, 30)) for _ in range(r.randint(0, 6))]
    texts, rest = [], []
    for _ in range(20):
        sizes = [r.randint(1, 60) for _ in range(n_lines)]
        sizes[r.randrange(n_lines)] += max(0, 51 - sum(sizes))
        passage = [line(n) for n in sizes]
        before, after = around(), around()
        texts += ["\n".join([*around(), *passage, *around()]), "\n".join([*before, *passage, *after])]
        rest += [texts[-2], "\n".join([*before, *after])]
    left = {x.doc_id: x.text for x in line_chunks.drop_repeated_chunks(frame(spark, texts)).collect()}
    assert left == {i: t for i, t in enumerate(rest) if t}


def test_passages_that_overlap_their_first_occurrence(spark):
    """Four equal lines, three of which make a passage: the second passage overlaps the first."""
    line = lambda k: " ".join(f"w{i}" for i in range(20)) + f" {k}"
    same = next(line(k) for k in range(99) if len(plain_chunks("\n".join([line(k)] * 4))) == 1)
    texts = ["\n".join([same] * 4), "\n".join(["own", *[same] * 3, "own end"]), "\n".join([same] * 7)]
    left = {x.doc_id: x.text for x in line_chunks.drop_repeated_chunks(frame(spark, texts)).collect()}
    assert left == {0: texts[0], 1: "own\nown end"}


# --- op3 ---


def test_packing(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(dict)
    rows = queries.op3_best_fit_packing(spark, SF_DIR).collect()
    for r in rows:
        pieces[r.doc_id][r.piece] = r
    for doc, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        parts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        found = [pieces[doc][k] for k in range(len(pieces[doc]))]
        assert [(r.start, r.length) for r in found] == [(4096 * k, len(p)) for k, p in enumerate(parts)]
        assert [r.ids_crc32 for r in found] == [zlib.crc32(struct.pack(f"<{len(p)}I", *p)) for p in parts]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.02 * total / 4096 + 1


def library_ids(path, texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in found]


# What the tokenizer's rules turn on: letters that change their number or place in another case, marks that join letters,
# contractions, signs before and behind, blanks of all kinds, and special strings in every spelling.
PARTS = [
    "a", "É", "é", "e\u0301", "\u0301", "\u0345", "İ", "ß", "ẞ", "Σ", "ς", "ΑΣ", "ŉ", "ǰ", "ǅ", "ﬁ", "\u212b", "\u212a", "Ⅳ", "½", "ª",
    "'s", "'LL", "it's", "’", ".", ",", "!!", "$$$", "...", "_", "-", "<|", "|>", "endoftext", "<|endoftext|>", "<|ENDOFTEXT|>",
    "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>", "\n", "\t", "\r", "\x0b", "\x1c", "\xa0", "\u2003", " ", " ", "  ",
    "1", "23", "漢字", "\u1112\u1161\u11ab", "\U0001f600", "\x00", "word", "Word", "WORD", "thing,", "The.", "x" * 70,
]


def test_ids_equal_the_library():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        settings = file.read()
    assert packing.Ids.fits(settings)
    ids, r = packing.Ids(settings), random.Random(8)
    for _ in range(20):
        texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(1000)]
        assert ids.of(texts) == library_ids(path, texts)


@pytest.mark.parametrize("special", ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>"])
def test_special_strings_in_every_spelling(spark, special):
    import public_tokenizers

    texts = [special, f"Word{special}word, {special} THE.", f"é {special}É", special * 3]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(frame(spark, texts)).collect()}
    whole = [ids + packing.END for ids in library_ids(public_tokenizers.path("word_bpe_49k.json"), texts)]
    assert got == {i: (len(ids) // 4, zlib.crc32(ids)) for i, ids in enumerate(whole)}


def test_packing_by_another_tokenizer(spark):
    """A file with other rules is left to the library."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello World, this  is A Test.", "", "<|endoftext|>x", "É \n\n y"]
    got = packing.pack_documents(frame(spark, texts), tokenizer_path=path).collect()
    whole = [ids + packing.END for ids in library_ids(path, texts)]
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {i: (len(w) // 4, zlib.crc32(w)) for i, w in enumerate(whole)}


@pytest.mark.parametrize("block", [7, 100, 10_000])
def test_packing_in_blocks(spark, block):
    r = random.Random(block)
    sizes = [r.choice([3, 50, 333, 700, 1500, 4096]) for _ in range(500)]
    cut = spark.createDataFrame([(i, 0, 0, s, 0) for i, s in enumerate(sizes)], packing.PIECES)
    got = packing.pack(cut, block_pieces=block).collect()
    assert sorted(x.doc_id for x in got) == list(range(500))
    fill = Counter()
    for x in got:
        fill[x.sequence_id] += x.length
    assert max(fill.values()) <= 4096 and len(fill) <= 1.25 * sum(sizes) / 4096 + 1


def test_sum_of_squares_takes_the_least_change():
    """Against a plain version that recounts all squares."""
    r = random.Random(5)
    for _ in range(20):
        sizes = np.array([r.randint(1, 20) for _ in range(60)])
        bins, placed = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            best = None
            for g in sorted({b for b in bins if b >= sizes[i]}):
                trial = Counter(bins)
                trial[g] -= 1
                trial[g - sizes[i]] += 1
                score = sum(n * n for gap, n in trial.items() if gap)
                if best is None or score < best[0]:
                    best = (score, g)
            gap = best[1] if best else 20
            if best:
                bins.remove(gap)
            placed[i] = 20 - gap
            bins.append(gap - sizes[i])
        _, offset = packing.sum_of_squares(sizes, 20)
        assert offset.tolist() == [placed[i] for i in range(len(sizes))]


# --- op4 ---


def test_contamination_across_blocks(spark, documents, monkeypatch):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items += [("short", "the of"), ("none", " ., "), ("copy", items[0][1])]
    items = [(str(i), t) for i, t in items]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = {d: (n, h, i) for d, n, h, i in brute.contamination(documents, items)}
    assert any(h for _, h, _ in expected.values())
    for words in (200_000, 300):
        monkeypatch.setattr(decontam, "BLOCK_WORDS", words)
        got = decontam.contamination(docs, benchmark).collect()
        assert len(got) == len(documents)
        for r in got:
            n, h, i = expected[r.doc_id]
            assert (r.n_words, r.n_hit, r.n_items) == (n, h, len(i))
            assert r.items_sha256 == hashlib.sha256(",".join(i).encode()).hexdigest()
            assert r.contaminated == (h > 0 and 20 * h >= n)


def test_fm_index():
    r = random.Random(2)
    for sigma in (1, 2, 7, 300):
        text = np.array([r.randint(0, sigma) for _ in range(400)], np.int32)
        index = decontam.FMIndex(text)
        for k in (1, 2, 5):
            phrases = np.array([[r.randint(1, sigma) for _ in range(k)] for _ in range(60)] + [text[i : i + k].tolist() for i in range(0, 390, 13)], np.int32)
            phrases = phrases[(phrases > 0).all(axis=1)]
            number, low, high = index.search(phrases)
            found = {int(n): sorted(index.locate(np.arange(a, b)).tolist()) for n, a, b in zip(number, low, high)}
            for n, phrase in enumerate(phrases.tolist()):
                places = [i for i in range(401 - k) if text[i : i + k].tolist() == phrase]
                assert found.get(n, []) == places


def test_benchmark_words_are_cut(spark):
    item = " ".join(f"b{i}" for i in range(13))
    clean = " ".join(f"c{i}" for i in range(400))
    docs = frame(spark, [clean, f"{clean}, {item.upper()}! {clean}", f"few words {item}", f"{item} x {item}", None])
    benchmark = spark.createDataFrame([("i", item)], "item_id string, text string")
    left = {r.doc_id: r for r in decontam.decontaminate(docs, benchmark).collect()}
    assert sorted(left) == [0, 1, 4]
    assert left[0].text == clean and left[1].text == f"{clean}, ! {clean}" and left[1].n_chars == len(left[1].text)


# --- op5 ---


def test_frequent_lines_per_host(spark):
    limits = line_quality.Limits(min_docs=4, max_percent=10, min_words=2)
    own = lambda i: f"own words of document {'x' * i if i != 'copy' else i} that no other has"
    rows = [(i, f"Share  this PAGE {i % 7}\n{own(i)}", "en", "a", 0) for i in range(5)]
    rows += [(10 + i, f"Share this page 1\n{own(10 + i)}", "en", "b", 0) for i in range(3)]
    rows += [(20, "share this page 9", "en", "a", 0)]
    rows += [(30 + i, own("copy"), "en", "a", 0) for i in range(9)]  # copies are one document
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in line_quality.line_verdicts(docs, limits).collect()}
    assert all(got[i].n_removed_lines == 1 and got[i].kept for i in range(5))
    assert all(got[10 + i].n_removed_lines == 0 and got[10 + i].kept for i in range(3))
    assert got[20].depleted and not got[20].kept
    assert all(got[30 + i].n_removed_lines == 0 and got[30 + i].kept for i in range(9))
    left = {r.doc_id: r.text for r in line_quality.keep_good(docs, limits).collect()}
    assert left[0] == own(0) and left[10].startswith("Share") and 20 not in left


def test_limits_at_every_size(spark):
    """With production limits: shares cut in small and large hosts, a few documents never do, and many do without a share."""
    letters = str.maketrans("0123456789", "abcdefghij")  # as digits don't tell lines apart
    own = lambda i: " ".join(f"w{i} n{k}" for k in range(30)).translate(letters)
    rows = []

    def host(name, n, sharing, line):
        for i in range(n):
            text = f"{line}\n{own(len(rows))}" if i < sharing else own(len(rows))
            rows.append((len(rows), text, "en", name, 0))

    host("small", 20, 5, "small host line")  # 25 %
    host("tiny", 4, 4, "tiny host line")  # all, but under the floor
    host("large", 300, 16, "large host line")  # 5.3 %
    host("under", 300, 15, "line at the limit")  # 5 %
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)

    def cut(limits=line_quality.Limits()):
        return {r.source for r in line_quality.keep_good(docs, limits).join(docs.select("doc_id", F.col("text").alias("before")), "doc_id").filter("text != before").collect()}

    assert cut() == {"small", "large"}
    assert cut(line_quality.Limits(max_docs=14)) == {"small", "large", "under"}
    assert cut(line_quality.Limits(max_docs=3)) == {"small", "large", "under", "tiny"}


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.1"])
def test_frequent_lines_of_the_tables(spark, sf_dir):
    """The production limits act on the given tables, whatever their size."""
    got = line_quality.line_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = got.agg(
        F.count_if(F.col("n_removed_lines") > 0).alias("cut"), F.count_if("depleted").alias("depleted"), F.count("*").alias("n")
    ).first()
    assert found.cut > 0.01 * found.n and found.depleted < 0.01 * found.n


# --- op6 ---


def test_license_scan(spark):
    filler = " ".join(f"f{i}" for i in range(100))
    by_name = dict(license_scan.TEMPLATES)
    long = by_name["mit-notice"].split()
    texts = [f"{filler} {t}\n{filler}" for _, t in license_scan.TEMPLATES]
    texts += [filler, f"{filler} {' '.join([*long[:-2], 'other', 'end'])}", f"{filler} {' '.join(long[: len(long) // 2])}"]
    got = [r.licenses for r in license_scan.scan(frame(spark, texts)).orderBy("doc_id").collect()]
    names = [n for n, _ in license_scan.TEMPLATES]
    assert all(name in found.split(",") for name, found in zip(names, got))
    assert got[len(names)] == "" and got[len(names) + 1] == "mit-notice" and got[len(names) + 2] == ""


def plain_shingles(text):
    w = [x for x in re.split(r"[^\w]|_", text.lower()) if x]
    return w, min(5, len(w))


def made_templates(r, n, words):
    return [(f"t{k:02}", " ".join(f"{k}w{r.randrange(40)}" for _ in range(words))) for k in range(n)]


def edited(r, template, share):
    w = template.split()
    for i in r.sample(range(len(w)), round(share * len(w))):
        w[i] = "edit"
    return " ".join(w)


def plain_licenses(text, templates):
    found = set()
    w, _ = plain_shingles(text)
    for name, template in templates:
        t, k = plain_shingles(template)
        own = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)}
        places = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
        for start in range(0, len(places) + 1, len(own)):
            inside = set(places[start : start + 2 * len(own)]) & own
            if 100 * len(inside) >= 80 * len(own):
                found.add(name)
    return ",".join(sorted(found))


def test_bands_retrieve_what_containment_finds(spark):
    """50 templates of 60 words, whole and edited, against a plain scan; without the bands' join nothing is found."""
    r = random.Random(4)
    templates = made_templates(r, 50, 60)
    filler = lambda: " ".join(f"f{r.randrange(10**6)}" for _ in range(r.randrange(200)))
    texts = [f"{filler()} {edited(r, t, share)} {filler()}" for _, t in templates for share in (0, 0.02, 0.035, 0.05)]
    docs = frame(spark, texts)
    expected = [plain_licenses(t, templates) for t in texts]
    assert [r.licenses for r in license_scan.scan(docs, templates).orderBy("doc_id").collect()] == expected
    assert 50 <= sum(x != "" for x in expected) < len(texts)
    sets = license_scan.template_sets(spark, templates)
    found = license_scan.windows(docs, sets.collect())
    met = license_scan.retrieved(found, sets)
    # The join is what retrieves: other minima meet nothing, and most windows and templates never meet.
    other = sets.withColumn("shingles", F.transform("shingles", lambda h: h + 1))
    assert license_scan.retrieved(found, other).count() == 0
    assert 50 <= met.count() <= 4 * len(texts)


def test_many_long_templates_take_seconds(spark):
    r = random.Random(5)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    begun = time.monotonic()
    assert license_scan.scan(docs, made_templates(r, 50, 60)).filter("n_licenses > 0").count() == 0
    assert time.monotonic() - begun < 60


def test_bands_reach_the_stated_probability():
    j = 0.8 / (2 + 0.2)
    assert (1 - j) ** license_scan.BANDS < 2e-8


# --- op7 ---


def test_clauses():
    model = toxicity.Model({"gronk": 6.0, "snarl": 5.0})
    weight = lambda text: max(model.features(text)[0], 0.0)
    plain = weight("such a gronk")
    assert plain > 0 and weight("you gronk") > plain
    assert weight("gronk that you are") == weight("you are a gronk") > plain  # a target on either side
    assert weight("not a gronk") < plain / 5 and weight("they are not at all in any way a gronk") > plain
    assert weight("she said he is a gronk") < weight("he is a gronk")
    assert weight("she said hello. he is a gronk") == weight("he is a gronk")  # the report ends with its clause
    assert weight("kill the process") == 0 and weight("i will kill you") == weight("you i will kill") > 0 and weight("") == 0
    assert plain < weight("such a gronk snarl") < weight("such a gronk and a snarl")


def plain_weight(clause):
    """The five rules, each by its own words, on a clause of (symbol, weight)."""
    total, symbols = 0.0, [x for x, _ in clause]
    for i, (symbol, weight) in enumerate(clause):
        if symbol not in ("I", "T"):
            continue
        aimed = "Y" in symbols
        factor = (toxicity.TARGETED if aimed else 1.0) if symbol == "I" or aimed else 0.0
        if "N" in symbols[max(0, i - 3) : i]:
            factor *= toxicity.NEGATED
        if "R" in symbols[:i]:
            factor *= toxicity.REPORTED
        if i and symbols[i - 1] == symbol:
            factor *= toxicity.SAME_PHRASE
        total += weight * factor
    return total


def all_paths(machine, clause):
    """Every path that is accepted, walked one by one."""
    def walk(state, at, total):
        if at == len(clause):
            return [total] if machine.accepts(state) else []
        symbol, weight = clause[at]
        return [x for after, factor in machine.step(state, symbol) for x in walk(after, at + 1, total + weight * factor)]

    return [x for start in machine.starts for x in walk(start, 0, 0.0)]


def test_the_composed_machine_equals_its_rules():
    r = random.Random(12)
    for _ in range(3000):
        clause = [(x, r.choice([4.0, 5.0, 7.5]) if x in "IT" else 0.0) for x in r.choices("IIITTYNRoooo", k=r.randint(0, 9))]
        paths = all_paths(toxicity.GRAMMAR, clause)
        assert len(paths) == 1  # of the guesses about a target, one is right
        assert toxicity.GRAMMAR.weigh(clause) == pytest.approx(max(paths)) == pytest.approx(plain_weight(clause))


def test_composition_multiplies():
    both = toxicity.NEGATION.compose(toxicity.REPORT)
    [state] = both.starts
    for symbol in "NR":
        [(state, _)] = both.step(state, symbol)
    assert both.step(state, "I")[0][1] == toxicity.NEGATED * toxicity.REPORTED


def test_the_grammar_tells_apart_what_a_lexicon_does_not():
    """Clauses with the same words: aimed insults and threats, against negated, reported and aimless ones."""
    r = random.Random(13)
    insult, threat = lambda: r.choice(toxicity.INSULTS), lambda: r.choice(toxicity.THREATS[:8])
    neutral = lambda: " ".join(r.choice("lamp river stone paper window garden".split()) for _ in range(r.randint(3, 9))) + "."
    toxic = [lambda: f"you are a {insult()}.", lambda: f"{insult()}, that is what they are.", lambda: f"i will {threat()} you."]
    clean = [lambda: f"nobody here is not a {insult()}.", lambda: f"the report said the word {insult()} twice.",
             lambda: f"we had to {threat()} the process.", lambda: f"this is never {insult()}."]
    texts = [(" ".join([neutral(), r.choice(kinds)(), neutral()]), y) for y, kinds in ((1, toxic), (0, clean)) for _ in range(300)]
    model = toxicity.Model()
    words = {w for w, (symbol, _) in model.words.items() if symbol in "IT"}

    def auc(value):
        good, bad = [[value(t) for t, y in texts if y == k] for k in (0, 1)]
        return np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])

    grammar = auc(lambda t: model.score(model.features(t)[:3]))
    lexicon = auc(lambda t: sum(w in words for w in re.findall(r"\w+", t)))
    assert grammar > 0.97 and lexicon < 0.6


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, sf_dir).collect()
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    bad = np.array([r.score for r in got if r.held_out and labels.get(r.doc_id) == 1])
    good = np.array([r.score for r in got if r.held_out and labels.get(r.doc_id) == 0])
    assert (bad[:, None] > good[None, :]).mean() + (bad[:, None] == good[None, :]).mean() / 2 > 0.93
    assert (bad >= 0.5).mean() > 0.85 and (good >= 0.5).mean() < 0.02


# --- op8 ---


def test_shards(spark, documents):
    got = queries.op8_sharding(spark, SF_DIR).collect()
    texts = dict(documents)
    by_shard = defaultdict(list)
    for r in sorted(got, key=lambda r: r.doc_id):
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        by_shard[r.shard].append(r)
    assert sorted(by_shard) == list(range(16))
    assert [r.doc_id for s in sorted(by_shard) for r in by_shard[s]] == sorted(texts)  # contiguous
    assert all([r.slot for r in rows] == list(range(len(rows))) for rows in by_shard.values())
    sizes = [sum(r.size for r in rows) for rows in by_shard.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)


def test_more_shards_than_documents(spark):
    got = sharding.shard_by_bytes(frame(spark, ["a", "b"]), 16).collect()
    assert sorted((r.doc_id, r.slot) for r in got) == [(0, 0), (1, 0)]


# --- op9 ---


def test_classes_of_the_table(spark, documents):
    got = queries.op9_minhash_near_dedup(spark, SF_DIR).collect()
    expected = brute.near_classes(documents)
    assert {r.doc_id: r.class_id for r in got} == expected
    assert {r.doc_id for r in got if r.representative} == set(expected.values())


def test_chains_and_large_groups(spark):
    """A chain whose ends are unlike is one class; texts that only share a passage are not."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    chain = []
    for _ in range(8):
        words = list(words)
        for i in r.sample(range(len(words)), 3):
            words[i] = f"n{r.random()}"
        chain.append(" ".join(words))
    shared = " ".join(f"s{i}" for i in range(60))
    unlike = [f"{shared} " + " ".join(f"u{r.random()}" for _ in range(60)) for _ in range(40)]
    family = []
    for _ in range(60):
        v = [f"f{i}" for i in range(200)]
        v[r.randrange(200)] = f"x{r.random()}"
        family.append(" ".join(v))
    texts = chain + unlike + family
    got = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute.near_classes(list(enumerate(texts)))
    assert {got[i] for i in range(8)} == {0} and len({got[i] for i in range(48, 108)}) == 1


def test_parts_in_other_orders_are_not_paired(spark, monkeypatch):
    """Texts of the same parts in different orders share nearly all k-mers; fewer pairs than
    texts are compared. Near copies of some of them are still found."""
    r = random.Random(6)
    parts = [" ".join(f"p{r.randrange(20_000)}" for _ in range(40)) for _ in range(12)]
    texts = [" ".join(r.sample(parts, len(parts))) for _ in range(400)]
    for i in range(20):
        words = texts[i].split()
        words[100 + i] = "changed"
        texts.append(" ".join(words))
    compared = []
    verified = order_minhash._verified

    def counted(pairs, rows):
        compared.append(pairs.count())
        return verified(pairs, rows)

    monkeypatch.setattr(order_minhash, "_verified", counted)
    for n in (100, 300):
        compared.clear()
        some = texts[:n] + texts[400:]
        got = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(frame(spark, some)).collect()}
        assert got == {i: i if i < n else i - n for i in range(n + 20)}
        # The last step. All pairs would be 7,000 and 51,000.
        assert compared[-1] <= n
    few = texts[:12] + texts[400:412]
    got = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(frame(spark, few)).collect()}
    assert got == brute.near_classes(list(enumerate(few)))


def test_short_and_repeating_texts_meet_again(spark):
    """Near copies beside many unlike texts of the same lines: many classes of short texts, and texts of which lines repeat."""
    r = random.Random(7)
    base = [" ".join(f"b{r.randrange(900)}" for _ in range(16)) for _ in range(5)]
    texts = []
    for _ in range(10):
        for words in (" ".join(r.sample(base, 5)), " ".join(x + " same line again and again here" for x in r.sample(base, 5))):
            texts += [words, words + " end", "start " + words]
    got = {x.doc_id: x.class_id for x in order_minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute.near_classes(list(enumerate(texts)))


def test_places_of_pairs_at_the_limit_agree(spark):
    """Random pairs of the least similarity, of all sizes, with repeats and with their changes at one end, pass the bound on places;
    moved halves don't."""
    r = random.Random(8)
    rows, wanted = [], []

    def pair(a, b, similar):
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert (order_minhash.aligned(x, y) >= order_minhash.SIMILAR) == similar
        sampled = [order_minhash.placed(k).tolist() for k in (x, y)]
        rows.append((len(rows), len(a), len(b), *sampled))
        wanted.append(similar)

    for size in (5, 12, 40, 100, 300, 2000, 70_000):
        for kinds in (10**9, max(2, size // 3)):
            a = [r.randrange(kinds) for _ in range(size)]
            changed = int(size / 9)
            at = r.sample(range(size), changed)
            pair(a, [10**9 + i if i in set(at) else x for i, x in enumerate(a)] if size < 70_000 else a, True)
            cut = size // 5 if size >= 5 else 0
            pair(a, a[cut:], True)
            pair(a[cut:], a, True)
        if size >= 40:
            a = [r.randrange(10**9) for _ in range(size)]
            pair(a, a[size // 2 :] + a[: size // 2], False)
    schema = "n int, _size long, _lead_size long, _placed array<int>, _lead_placed array<int>"
    kept = {x.n for x in spark.createDataFrame(rows, schema).filter(order_minhash._agreed()).collect()}
    assert kept == {n for n, similar in enumerate(wanted) if similar}


@pytest.mark.parametrize("n", [1, 5, 60])
def test_banded_alignment(n):
    r = random.Random(n)
    for _ in range(60):
        a = [r.randrange(6 * n) for _ in range(n)]
        b = list(a)
        for _ in range(r.randint(0, max(1, n // 8))):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randint(0, 2)] = [r.randrange(6 * n) for _ in range(r.randint(0, 2))]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        c = brute.common_subsequence(a, b)
        exact = c / (len(a) + len(b) - c) if a and b else 0.0
        found = order_minhash.aligned(x, y)
        assert (found >= 0.8) == (exact >= 0.8) and (exact < 0.8 or found == pytest.approx(exact))


# --- op10 ---


def test_token_counts(spark, documents):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(documents)
    for r in queries.op10_token_counts(spark, SF_DIR).collect():
        n = len(model.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


def test_merges_of_odd_texts():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, pieces = sentencepiece.SentencePieceProcessor(model_file=path), token_count.Pieces(path)
    r = random.Random(1)
    signs = "abcdefgh   \n\téüè日本語\U0001f600▁ 0123<s></s>.,'\x00 the ing"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 3000, "日" * 2000, "<s>", "▁"]
    assert [pieces.count(t) for t in texts] == [len(x) for x in model.encode(texts)]


def test_a_model_can_be_given(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    got = token_count.count_tokens(frame(spark, ["some words", None]), model_path=path).collect()
    assert sorted(r.n_tokens for r in got)[0] == 0


def test_order_of_ids_is_not_an_input(spark):
    """The test fold follows the id's digits."""
    ids = spark.range(200).select("id", toxicity.in_test_fold(F.col("id")).alias("held"))
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids.collect())
