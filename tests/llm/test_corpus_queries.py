"""Every corpus query over edge rows and empty tables, against brute force in plain Python."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from corpus import documents, toxic_labels, write
from shoplens.llm import quality, toxicity

BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
PAGES = [(1, "u1", "<p>a</p>", "x", 1), (2, "u2", "<p>a</p>", "x", 1), (3, None, None, "x", 1),
         (4, "u4", "", "x", 1), (5, "u\r\nBad: 1", "é" * 10, "x", 1), (1, "u1", "<p>a</p>", "x", 1),
         (None, "u9", "<p>a</p>", "x", 1), (None, "u8", "lonely", "x", 1), (7, "", "z" * 200_000, "x", 1)]
QUERIES = [q for q in E.queries() if re.match(r"op\d+_|pipeline", q)]


@pytest.fixture(scope="module")
def docs():
    return documents()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("edge"), docs, toxic_labels(docs), PAGES)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"))


def rows(spark, folder, name):
    key = next(q for q in QUERIES if q.startswith(name))
    return [r.asDict() for r in E.queries()[key](spark, folder).collect()]


def counted(pairs):
    return Counter(map(repr, pairs))


@pytest.mark.parametrize("name", QUERIES)
def test_empty_table(spark, empty, name):
    assert E.queries()[name](spark, empty).collect() == []


def test_op1(spark, folder, docs):
    got = rows(spark, folder, "op1")
    texts = {}
    for d in docs:
        texts.setdefault(d[1] or "", set())
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    unique = {d[0]: d[1] or "" for d in docs if d[0] is not None}
    once = Counter(d[0] for d in docs)
    order = sorted(unique, reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    assert counted((r["doc_id"], r["n_chars"]) for r in got) == counted((d[0], len(d[1] or "")) for d in docs)
    for a, b in zip(order, order[1:]):
        if once[a] == 1:
            t, n = unique[a], len(unique[a])
            edited = t[:n - n // 2] + unique[b][:n // 2]
            assert by_id[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    every = {int(r["fingerprint"], 16) for r in got}
    for r in got:
        f = int(r["fingerprint"], 16)
        assert r["near_fingerprints"] == sum(0 < (f ^ x).bit_count() <= 7 for x in every)
    seen = {}
    for r in got:
        if r["doc_id"] in unique:
            assert seen.setdefault(unique[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_op1_wraps_around(spark, tmp_path):
    docs = [(i, t, None, None, 1, "", 1, 1.0, 1, "", 1, 1) for i, t in ((9000, "abcd"), (10, "efgh"), (2, "ij"))]
    got = {r["doc_id"]: r["edited_sha256"] for r in rows(spark, write(spark, tmp_path, docs), "op1")}
    want = {9000: "abef", 10: "efij", 2: "ia"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def brute_pieces(docs):
    out = []
    for d in docs:
        ids = BYTE.encode(d[1] or "", add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or 1024
        cuts = [0, len(ids)] if len(ids) <= 1024 else [0, *range(head, len(ids) + 1, 1024)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((d[0], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_packed(got, want):
    assert counted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == counted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(w[3] for w in want) // 1024) + 1


def test_op2(spark, folder, docs):
    check_packed(rows(spark, folder, "op2"), brute_pieces(docs))


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    wins = [tuple(words[i:i + 3]) for i in range(n - 2)]
    times = Counter(wins)
    hit = {j for i, w in enumerate(wins) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def test_op3(spark, folder, docs):
    got = rows(spark, folder, "op3")
    assert counted(tuple(r[c] for c in ("doc_id", *quality.MEASURES[:5])) for r in got) == counted(
        (d[0], *brute_quality(d[1])) for d in docs)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["failures"] == 0)
    assert any(r["kept"] for r in got)


def test_op4(spark, folder, docs):
    got = rows(spark, folder, "op4")
    assert counted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == counted(
        (d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append((r["slot"], r["hilbert"]))
    assert set(slots) == set(range(16))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    curve = [h for s in range(16) for _, h in sorted(slots[s])]
    assert curve == sorted(curve)
    assert all([x for x, _ in sorted(v)] == list(range(len(v))) for v in slots.values())


def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(docs):
    """Smallest doc_id reachable over fingerprints at most 4 bits apart, by document row."""
    fps = [brute_simhash(d[1]) for d in docs]
    kinds = sorted(set(fps))
    group = {f: f for f in kinds}
    for f in kinds:
        for g in kinds:
            if (f ^ g).bit_count() <= 4 and group[f] != group[g]:
                old, new = group[g], group[f]
                group = {k: new if v == old else v for k, v in group.items()}
    best = {}
    for f, d in zip(fps, docs):
        if d[0] is not None:
            best[group[f]] = min(best.get(group[f], d[0]), d[0])
    return [(d[0], f"{f:016x}", best.get(group[f])) for f, d in zip(fps, docs)]


def test_op5(spark, folder, docs):
    got = rows(spark, folder, "op5")
    assert counted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == counted(brute_classes(docs))


def test_op6(spark, folder, docs):
    want = []
    for d in docs:
        ids = WORD.encode(d[1] or "", add_special_tokens=False).ids
        text = WORD.decode(ids, skip_special_tokens=False)
        want.append((d[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    got = rows(spark, folder, "op6")
    assert counted(tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in got) == counted(want)


def test_op7(spark, folder, docs):
    got = rows(spark, folder, "op7")
    assert counted(r["doc_id"] for r in got) == counted(d[0] for d in docs)
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op8(spark, folder, docs, tmp_path):
    assert rows(spark, folder, "op8") == []
    notice = "Licensed under the Apache License, Version 2.0."
    near = "licensed under THE Apache license, edition version 2.0"
    pad = "wörter davor " * 50
    plants = [notice, pad + notice + "\n" + pad + near + " end", near, "Licensed under nothing", None, "", notice[:20]]
    planted = [(i, t, None, None, 1, "", 1, 1.0, 1, "", 1, 1) for i, t in enumerate(plants)]
    got = rows(spark, write(spark, tmp_path, planted), "op8")
    spans = sorted((r["doc_id"], plants[r["doc_id"]][r["start"]:r["end"]]) for r in got)
    assert spans == sorted([(0, notice), (1, notice), (1, near), (2, near)])
    assert all(r["license"] == "Apache-2.0" and r["coverage"] >= 0.8 for r in got)


def test_op9(spark, folder, docs):
    want = []
    for d in docs:
        n = len(WORD.encode(d[1] or "", add_special_tokens=False).ids)
        want.append((d[0], len((d[1] or "").encode()), n, n > 2048))
    got = rows(spark, folder, "op9")
    assert counted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_tokens", "over_limit")) for r in got) == counted(want)


def test_op10(spark, folder):
    want, first = [], {}
    for i, _, html, *_ in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0, p[1] or "")):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = digest in first
        first.setdefault(digest, i)
        want.append((i, len(data), digest, "revisit" if again else "response", first[digest] if again else None))
    got = rows(spark, folder, "op10")
    assert counted(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                   for r in got) == counted(want)


def test_pipeline(spark, folder, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "simhash_near_dedup", "best_fit_packing"]
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = []
    for d in docs:
        n, chars, symbols, dups, repeats = brute_quality(d[1])
        lines = [x for x in (d[1] or "").split("\n") if x.strip()]
        if not (n < 50 or 2 * repeats > n or 4 * symbols > n or (len(lines) >= 4 and 10 * dups > 3 * len(lines))
                or not 2 * n <= chars <= 25 * n or 4 * (d[1] or "").count("!!") > n):
            kept.append(d)
    after = corpus_pipeline.STAGES[0][1](spark, table, folder)
    assert after.columns == table.columns
    assert counted(tuple(r) for r in after.collect()) == counted(kept)
    model = toxicity.fit(spark, after, labels)
    scores = model.score([(d[1] or "").encode() for d in kept])
    kept = [d for d, s in zip(kept, scores) if s < 0.5]
    after = corpus_pipeline.STAGES[1][1](spark, after, folder)
    assert after.columns == table.columns
    assert counted(tuple(r) for r in after.collect()) == counted(kept)
    chosen = []
    for d, (_, fp, component) in zip(kept, brute_classes(kept)):
        if d[0] is not None and d[0] == component and all(c[0] != d[0] for c in chosen):
            chosen.append(d)
    after = corpus_pipeline.STAGES[2][1](spark, after, folder)
    assert after.columns == table.columns
    assert counted(r["doc_id"] for r in after.collect()) == counted(d[0] for d in chosen)
    check_packed([r.asDict() for r in corpus_pipeline.run(spark, folder).collect()], brute_pieces(chosen))


def test_near_dedup_stage_without_keys(spark, folder):
    from corpus import DOCS
    base = " ".join(f"w{i}" for i in range(80))
    rows_ = [(None, t, None, None, 1, "", 1, 1.0, 1, "", 1, 1) for t in (base, base, base + " x", "another text", None, "")]
    out = corpus_pipeline.STAGES[2][1](spark, spark.createDataFrame(rows_, DOCS), folder)
    # one of the copies, the other text, one of the two without words
    assert len(out.collect()) == len({c for c in near_groups([r[1] for r in rows_])})


def test_near_dedup_stage_with_one_id_on_unrelated_texts(spark, tmp_path):
    from corpus import DOCS
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(80)) for k in "abcd")
    pairs = [(1, a), (1, b), (2, b), (3, c), (5, c), (5, d), (5, d), (None, d), (4, None), (4, a)]
    rows_ = [(i, t, None, None, 1, "", 1, 1.0, 1, "", 1, 1) for i, t in pairs]
    out = corpus_pipeline.STAGES[2][1](spark, spark.createDataFrame(rows_, DOCS), str(tmp_path))
    assert counted((r["doc_id"], r["text"]) for r in out.collect()) == counted([(1, a), (1, b), (3, c), (5, d), (4, None)])


def near_groups(texts):
    return [c for _, _, c in brute_classes([(i, t) for i, t in enumerate(texts)])]
