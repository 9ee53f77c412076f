"""The pipeline against stages in plain Python, whole rows after each stage."""

import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from panelloom.llm import quality_rules, secret_scan
from panelloom.llm.queries import tokenizer_file
from panelloom.session import materialize

from .test_text_operators import WORD, linked_by_pairs, lower

SF = "/root/testdata/sf0.001"
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def good(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    twice = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    if len(words) < 50 or 100 * len(twice) > 50 * len(words):
        return False
    stop = sum(w.lower() in quality_rules.STOP_WORDS for w in words)
    return (
        3 <= sum(map(len, words)) / len(words) <= 12 and sum(c in "#*$%&|<>" for c in text) / len(words) <= 0.1
        and stop / len(words) >= 0.06 and (len(lines) - len(set(lines))) / len(lines) <= 0.4
    )


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_of_each_group(rows):
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, r in zip(group, rows):
        least[g].append(r)
    return [min(g) for g in least.values()]


def without_benchmark(rows, items):
    windows = set()
    for text in items:
        words = [lower(w) for w in BENCH_WORD.findall(text or "")]
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}
    for row in rows:
        text = row[1] or ""
        places = [m.span() for m in BENCH_WORD.finditer(text)]
        words = [lower(text[a:b]) for a, b in places]
        hit = {j for n in sizes for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for j in range(i, i + n)}
        if 2 * len(hit) > len(words):
            continue
        out, at, i = [], 0, 0
        while i < len(words):
            if i in hit:
                end = i
                while end + 1 in hit:
                    end += 1
                out.append(text[at : places[i][0]])
                at, i = places[end][1], end
            i += 1
        yield (row[0], "".join([*out, text[at:]]) if row[1] is not None else None, *row[2:])


def masked(text):
    out, at = [], 0
    for start, end in sorted((s, e) for s, _, e in linked_by_pairs(text)):
        if start > at or not out:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return text if not out else "".join([*out, text[at:]])


def compare(spark, docs, folder, items):
    """Every stage on what the plain stages before it leave."""
    stages = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in docs.collect()]
    schema = docs.schema
    plain = {
        "quality_rules": lambda rows: [r for r in rows if good(r[1])],
        "near_duplicates": smallest_of_each_group,
        "decontamination": lambda rows: list(without_benchmark(rows, items)),
        "secret_scan": lambda rows: [(r[0], masked(r[1]), *r[2:]) for r in rows],
    }
    for name, expected in plain.items():
        docs = materialize(stages[name](spark, docs, folder), "stage")
        rows = expected(rows)
        assert docs.columns == schema.names and Counter(map(tuple, docs.collect())) == Counter(rows), name
    packed = [r.asDict() for r in stages["packing"](spark, docs, folder).collect()]
    encode = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")).encode
    want = Counter()
    for row in rows:
        ids = np.array([*(encode(row[1], add_special_tokens=False).ids if row[1] else []), 1], "<u4")
        for at in range(0, len(ids), 2048):
            want[row[0], at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packed) == want
    ends = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert all(n <= 2048 for n in ends.values())
    return packed


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    packed = compare(spark, docs, SF, items)
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(map(tuple, whole.collect())) == Counter(
        (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packed
    )


def test_stages_on_odd_documents(spark, tmp_path, odd_docs):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_empty_tables_go_through(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert secret_scan.redact(no_docs).collect() == []
