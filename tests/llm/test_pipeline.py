"""The whole pipeline against plain versions of its stages."""

import re
import struct
import zlib
from collections import Counter

import corpus_pipeline
from callmill.llm import order_minhash, packing
from tests.llm import brute
from tests.llm.test_operators import plain_removals

SF_DIR = "/root/testdata/sf0.01"


def base_failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return len(words) < 20 or 100 * len(covered) > 30 * len(words)


def normalised(line):
    return re.sub("[0-9]", "0", re.sub(r"[ \t\n\x0B\f\r]+", " ", line.lower()).strip(" "))


def good(docs):
    """(id, text) of documents (id, text, source) that are kept, without the lines that many texts of their host have."""
    worded = lambda line: re.search(r"[^ \t\n\x0B\f\r]", line)
    hosts, counts, out = Counter(), Counter(), []
    for source, text in {(source, text or "") for _, text, source in docs}:
        hosts[source] += 1
        counts.update({(source, normalised(x)) for x in text.split("\n") if worded(x)})
    for doc, text, source in docs:
        if base_failed(text):
            continue
        n = {x: counts[source, normalised(x)] for x in text.split("\n") if worded(x)}
        cut = {x for x, k in n.items() if k >= 5 and 100 * k > 5 * hosts[source] or k > 10_000}
        chars = lambda lines: sum(len(re.sub(r"[ \t\n\x0B\f\r]", "", x)) for x in lines)
        lines = text.split("\n")
        left = [x for x in lines if x not in cut]
        if 100 * chars(left) >= 50 * chars(lines):
            out.append((doc, "\n".join(left), text))
    assert sum(left != text for _, left, text in out) > 50
    return [(doc, left) for doc, left, _ in out]


def without_chunks(docs):
    """Texts without what occurs earlier; those left without a word go."""
    removed = plain_removals(docs)
    return [(doc, removed[doc][3]) for doc, _ in docs if not removed[doc][2] or removed[doc][3].strip()]


def without_benchmark(docs, items):
    """Contaminated documents go; in the others the hit words go, with what stands between neighbouring ones."""
    owners = {}
    for item, text in items:
        w = brute.words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            owners[tuple(w[i : i + k])] = item
    out = []
    for doc, text in docs:
        w = brute.words(text)
        ranges = sorted((i, i + k) for k in {len(x) for x in owners} for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in owners)
        merged = []
        for a, b in ranges:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        hit = sum(b - a for a, b in merged)
        if hit and 20 * hit >= len(w):
            continue
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
        assert len(places) == len(w)
        for a, b in reversed(merged):
            text = text[: places[a][0]] + text[places[b - 1][1] :]
        out.append((doc, text))
    return out


def test_pipeline_equals_plain_stages(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs = without_chunks(good(docs))
    classes = brute.near_classes(docs)
    docs = without_benchmark([(d, t) for d, t in docs if classes[d] == d], items)
    expected = []
    for doc, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((doc, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_a_worker_holds_the_lookups_of_one_operator():
    ids = packing._ids(None)
    first = ids.of(["some words and some more"])
    assert len(ids.known) > 1
    kmers = order_minhash.shingles(b"a text of six words, here")
    assert len(ids.known) == 1 and not ids.older and order_minhash._HASHES
    assert packing._ids(None) is ids and not order_minhash._HASHES
    # What was dropped is found anew.
    assert ids.of(["some words and some more"]) == first
    assert order_minhash.shingles(b"a text of six words, here").tolist() == kmers.tolist()
