"""op11, op12, op13: library interfaces and registered queries against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from corpus import documents, embeddings, write
from shoplens.llm import merkle, negatives, wavelet

BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs():
    return documents()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("three"), docs, vectors=embeddings())


def run(spark, folder, name):
    return [r.asDict() for r in E.queries()[name](spark, folder).collect()]


def counted(rows):
    return Counter(map(repr, rows))


# --- op11 ---------------------------------------------------------------------------

def shard_of(ids, bits=16):
    n = len(ids)
    pieces = {"row": [7], "doc_id": [1], "known": [1], "first": [0], "count": [n], "whole": [1]}
    data = wavelet.shard_bytes(np.array(ids, np.uint32), {k: np.array(v) for k, v in pieces.items()}, bits)
    reads = []

    def fetch(at, length):
        reads.append(length)
        return data[at:at + length]

    return wavelet.Shard(fetch), data, reads


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**17 - 1)), min_size=1, max_size=300))
def test_wavelet_equals_the_list(ids):
    shard, _, _ = shard_of(ids, 17)
    a = np.array(ids)
    assert shard.all().tolist() == ids
    assert shard.access(np.arange(len(ids))).tolist() == ids
    for token in {*ids[:6], 3, 2**17 - 1, 2**20}:
        assert shard.rank(token, np.arange(len(ids) + 1)).tolist() == [int((a[:i] == token).sum()) for i in range(len(ids) + 1)]
        assert shard.occurrences(token).tolist() == np.flatnonzero(a == token).tolist()
        assert shard.select(token, [-1, len(ids)]).tolist() == [-1, -1]


@pytest.mark.parametrize("n", [63, 64, 65, wavelet.BLOCK_BITS - 1, wavelet.BLOCK_BITS, wavelet.BLOCK_BITS + 1, 200_000])
def test_wavelet_at_block_ends(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.3, 2, rng.integers(0, 50_257, n))
    shard, _, _ = shard_of(ids)
    assert (shard.all() == ids).all()
    at = np.unique(np.clip([0, n - 1, n // 2, wavelet.BLOCK_BITS - 1, wavelet.BLOCK_BITS], 0, n - 1))
    assert (shard.access(at) == ids[at]).all()
    assert shard.rank(2, [0, n]).tolist() == [0, int((ids == 2).sum())]
    assert (shard.occurrences(2) == np.flatnonzero(ids == 2)).all()


def test_a_lookup_reads_few_blocks_and_the_file_is_smaller_than_its_ids():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 2_000_000), 50_256)
    shard, data, reads = shard_of(ids)
    assert len(data) < 2 * len(ids) * 0.8
    reads.clear()
    assert shard.access([1_234_567]).tolist() == [int(ids[1_234_567])]
    assert sum(reads) <= 16 * 9000


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_crc32_of_joined_parts(a, b):
    assert wavelet.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected_documents(docs):
    """Multiset of (doc_id, start, n_tokens, ids_crc32), as rows of one doc_id may stand in either order."""
    ids = [(d[0], BYTE.encode(d[1] or "", add_special_tokens=False).ids + [2]) for d in docs]
    return ids


def check_documents(got, docs):
    want = expected_documents(docs)
    assert counted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == counted(
        (d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in want)
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in want), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:  # gapless, in order of doc_id
        assert r["start"] == at
        at += r["n_tokens"]
        assert r["last_id"] == 2 and r["n_end_ids"] >= 1 and 0 <= r["end_at"] < r["n_tokens"]


def test_op11_equals_the_tokenizers_library(spark, folder, docs):
    check_documents(run(spark, folder, "op11_wavelet_token_shards"), docs)


def test_op11_documents_over_many_pieces_and_shards(spark, folder, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "PIECE", 50)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    out = f"file://{tmp_path}/archive"
    manifest = wavelet.write_archive(spark, df, out, public_tokenizers.path("byte_bpe_50k.json"), shard=400)
    assert manifest.count() > 20
    monkeypatch.undo()
    check_documents([r.asDict() for r in wavelet.read_archive(spark, manifest, out).collect()], docs)
    ids = expected_documents(docs)
    counts = Counter(x for _, i in ids for x in i)
    tokens = [2, 257, 50_000, ids[-1][1][0]]
    assert {r.token: r.n for r in wavelet.token_counts(manifest, out, tokens).collect()} == {t: counts[t] for t in tokens}
    token = ids[-1][1][0]
    found = wavelet.occurrences(manifest, out, token).collect()
    assert counted((r.doc_id, r.at) for r in found) == counted((d, k) for d, i in ids for k, x in enumerate(i) if x == token)
    assert len({r.place for r in found}) == len(found)


def test_files_of_lost_tries_are_not_read(spark, folder, docs, tmp_path):
    df = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 50")
    out = str(tmp_path / "archive")
    manifest = wavelet.write_archive(spark, df, out, public_tokenizers.path("byte_bpe_50k.json"))
    (tmp_path / "archive" / "shard-000000-000000-lost.wm").write_bytes(b"half a file")
    check_documents([r.asDict() for r in wavelet.read_archive(spark, manifest, out).collect()],
                    [d for d in docs if d[0] is not None and d[0] < 50])


# --- op12 ---------------------------------------------------------------------------

def valid(rows):
    """(id, label, integers) of the rows that take part, by plain loops."""
    out = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [max(-2**63, min(2**63 - 1, math.floor(256 * float(np.float32(x))))) for x in v]
        out.append((i, (label + 1) % 10 if i % 7 == 0 else label, ints))
    return out


def mined(rows, every=100):
    out = []
    for i, label, v in rows:
        if i % every:
            continue
        scored = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, m) for j, m, w in rows if j != i)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and -30 * s <= -100 * x[0] <= -90 * s][:10]
            out += [(i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(inside, 1)]
    return out


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_op12_equals_brute_force(spark, folder):
    want = mined(valid(embeddings()))
    got = [tuple(r[c] for c in NAMES) for r in run(spark, folder, "op12_secondary_sort_negatives")]
    assert len(want) > 300 and counted(got) == counted(want)


def test_op12_sql(spark, tmp_path):
    rows = [r for r in embeddings() if r[0] is not None and r[1] and len(r[1]) == 6
            and all(x is None or not math.isfinite(x) or abs(x) < 1e6 for x in r[1])]
    rows = list({r[0]: r for r in rows}.values())
    folder = write(spark, tmp_path, vectors=rows)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{folder}/embeddings.parquet/*.parquet')")
    rel = con.sql(E.oracle_sql()["op12_secondary_sort_negatives"])
    want = [tuple(r[rel.columns.index(c)] for c in NAMES) for r in rel.fetchall()]
    got = [tuple(r[c] for c in NAMES) for r in run(spark, folder, "op12_secondary_sort_negatives")]
    assert len(want) > 100 and counted(got) == counted(want)


def test_op12_small_blocks_give_the_same(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").selectExpr(
        "vec_id", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end", "cast(embedding as array<double>)")
    want = counted(mined(valid(embeddings()), 20))
    for rows in (16, 1000):
        got = negatives.hard_negatives(spark, vectors, 20, rows=rows).select(NAMES).collect()
        assert counted(tuple(r) for r in got) == want


@settings(max_examples=200)
@given(st.lists(st.tuples(st.integers(-2**63, 2**63 - 1), st.integers(0, 2**62), st.integers(-2**63, 2**63 - 1),
                          st.integers(0, 1), st.integers(-2**63, 2**63 - 1)), min_size=1, max_size=20))
def test_keys_sort_as_bytes_and_come_back(rows):
    parts = [(a, r, np.array([s], np.int64), k, np.array([o], np.int64)) for a, r, s, k, o in rows]
    keys = negatives.packed(parts)
    back = list(zip(*negatives.numbers(negatives.unpacked(keys))))
    assert back == rows
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1], -rows[i][2], rows[i][3], rows[i][4]))
    assert [rows[i] for i in order] == [rows[i] for i in sorted(range(len(rows)), key=lambda i: keys[i].as_py())]


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(2)
    for top in (100, 2**20, 2**26, 2**31 - 1, 2**62):
        a, b = rng.integers(-top, top, (4, 5)), rng.integers(-top, top, (6, 7))
        want = [[max(-2**63, min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in b] for u in a]
        assert negatives.products(a, b).tolist() == want


# --- op13 ---------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def marked(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, text):
    return sha("".join(map(marked, (d[0], d[3], d[2], d[4], text))))


def tree(nodes, fanout=8):
    """(top, path of each node as (left, right) pairs) by plain loops."""
    paths, cur, own = [[] for _ in nodes], nodes, [[i] for i in range(len(nodes))]
    while len(cur) > 1:
        above, owners = [], []
        for i in range(0, len(cur), fanout):
            part = cur[i:i + fanout]
            for j in range(len(part)):
                for m in own[i + j]:
                    paths[m].append(("".join(part[:j]), "".join(part[j + 1:])))
            above.append(sha("".join(part)))
            owners.append(sum(own[i:i + fanout], []))
        cur, own = above, owners
    return cur[0], paths


def proofs(docs, fanout=8):
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in order:
        inside = sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d, d[1])))
        built.append((inside, *tree([leaf(d, d[1]) for d in inside], fanout)))
    root, upper = tree([b[1] for b in built], fanout)
    for (inside, subroot, paths), up in zip(built, upper):
        for d, path in zip(inside, paths):
            path = path + up
            own = told = leaf(d, d[1])
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None:
                told = leaf(d, d[1].translate(LOWER))
            for left, right in path:
                told = sha(left + told + right)
            yield d[0], own, subroot, root, sha("".join(a + b for a, b in path)), told, told == root


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def wide(docs):
    """Languages of many sizes: one row, a full run, one more than a run, many."""
    n = {"a": 1, "b": 8, "c": 9, "é": 65, "": 2, None: 3, **{f"l{i}": 1 for i in range(9)}}
    rows = [(i * 3 % 1009, f"Text {i} ÄB", lang, None if i % 5 else "s", i) for i, lang in
            enumerate(g for g, k in n.items() for _ in range(k))]
    return docs + [r + docs[0][5:] for r in rows]


@pytest.mark.parametrize("more", [False, True])
def test_op13_equals_brute_force(spark, docs, tmp_path, more):
    rows = wide(docs) if more else docs
    got = run(spark, write(spark, tmp_path, rows), "op13_slot_pivot_merkle")
    want = list(proofs(rows))
    assert counted(tuple(r[c] for c in COLUMNS) for r in got) == counted(want)
    assert 0 < sum(r["verified"] for r in got) < len(got)


def test_op13_sql(spark, docs, tmp_path):
    folder = write(spark, tmp_path, wide(docs))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    rel = con.sql(E.oracle_sql()["op13_slot_pivot_merkle"])
    want = [tuple(r[rel.columns.index(c)] for c in COLUMNS) for r in rel.fetchall()]
    assert counted(want) == counted(proofs(wide(docs)))


def test_single_document_is_its_own_root(spark, tmp_path):
    d = (4, "ONE", "en", None, 3) + documents()[0][5:]
    r = run(spark, write(spark, tmp_path, [d]), "op13_slot_pivot_merkle")[0]
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha("")


def test_manifest_with_another_fanout(spark, docs):
    df = spark.createDataFrame([(i, f"g{i % 2}", sha(str(i))) for i in range(30)], "k long, grp string, d string")
    got = merkle.manifest(spark, df, "grp", "k", "d", fanout=3).withColumn("fold", merkle.fold(F.col("d"), F.col("path"))).collect()
    a, b = (tree([sha(str(i)) for i in range(g, 30, 2)], 3) for g in (0, 1))
    root = sha(a[0] + b[0])
    assert len(got) == 30 and {r.fold for r in got} == {r.root for r in got} == {root}


def test_ordered_rank_splits_a_hot_group(spark):
    df = spark.range(20_000).selectExpr("'g' as g", "cast(id / 4 as long) as k", "id as row")
    ranked = merkle.ordered_rank(spark, df, "g", ["k", "row"])
    assert ranked.where("idx <> row or n <> 20000").count() == 0


# --- the halves of earlier operators that their queries now show ----------------------------

def test_op3_shows_the_ablation_of_the_rule_that_alone_rejects(spark, folder):
    from shoplens.llm import quality
    got = run(spark, folder, "op3_rule_ledger")
    order = list(quality.RULES)
    for r in got:
        bits = [i for i in range(len(order)) if r["failures"] >> i & 1]
        if len(bits) != 1:
            assert r["alone"] is None and r["alone_docs"] is None and r["alone_words"] is None
            continue
        same = [x for x in got if x["failures"] == r["failures"]]
        assert (r["alone"], r["alone_docs"], r["alone_words"]) == (order[bits[0]], len(same), sum(x["n_words"] for x in same))
    assert len({r["alone"] for r in got}) > 2


def test_op10_rebuilds_every_record(spark, tmp_path):
    pages = [(1, "u1", "<p>a</p>", "x", 1), (2, "u\r\n2", "<p>a</p>", "x", 1), (3, None, "é", "x", 1), (4, "u4", None, "x", 1)]
    got = {r["page_id"]: r for r in run(spark, write(spark, tmp_path, pages=pages), "op10_content_addressed_warc")}

    def uuid(page, url):
        h = hashlib.md5(f"{page}\n{url or '-'}\n1".encode()).hexdigest()
        return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"

    for page, url, html, *_ in pages:
        r, body, again = got[page], (html or "").encode(), page == 2
        lines = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: {uuid(page, url)}",
                 "WARC-Date: 1970-01-01T00:00:00Z"]
        lines += [f"WARC-Target-URI: {url}".replace("\r", "%0D").replace("\n", "%0A")] if url else []
        lines += [f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
        lines += [f"WARC-Refers-To: {uuid(1, 'u1')}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "Refers-To-Page: 1"] if again else []
        lines += [f"Page: {page}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if again else len(body)}", "", ""]
        record = "\r\n".join(lines).encode() + (b"" if again else body) + b"\r\n\r\n"
        assert (r["record_bytes"], r["record_sha256"]) == (len(record), hashlib.sha256(record).hexdigest())
