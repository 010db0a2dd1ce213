"""Small corpora for the operator tests: edge rows, repeated rows, empty tables."""

import numpy as np

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "fingerprint string, piece int, score double, fp long, label string, component_id long, shard int")
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int, score double, rank int, block long, id long"
PAGES = "page_id long, url string, html string, digest string, copies int"
ODD = ["Hello <|endoftext|> wörld 123 don't ’s 　 x", "ΑΣ ΟΔΟΣ İstanbul ǅ",
       "a" * 500 + "'re''s 'll!!'d", "x́̀ é ½ Ⅷ ①२ 漢字かな 👩‍👩‍👧 \x1c\x85​ z", "ſ K Å",
       "<|startoftext|><|ENDOFTEXT|>", "ab" * 300 + " the" * 50, "﻿a\x00b'VE 'Ll", "", "   ", "\n\t ",
       "it's we'll they'rex 'vee ''t"]


def sentence(rng, n):
    parts = ["ka", "ro", "mi", "ten", "sul", "va", "dor", "pe", "lin", "gu"]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def documents():
    """Rows (doc_id, text, ...): nulls, empty, odd, very long, exact and near copies, repeated rows."""
    rng = np.random.default_rng(5)
    texts = [None, "", *ODD, "word", "two words", "x" * 50_000, sentence(rng, 20_000)]
    base = sentence(rng, 300)
    texts += [base, base, base.replace(" ", "  "), base + " extra", base.upper()]
    texts += [sentence(rng, int(n)) for n in rng.integers(1, 400, 60)]
    texts += ["spam spam spam spam " * 40, "a### b$$$ c%%% " * 30, "same line here\n" * 30]
    rows = [(i * 7 % 1000, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4],
             None if i % 11 == 0 else len(t or ""), "x", 1, 0.5, 2, "l", 3, 4)
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[20]]  # repeated rows
    rows += [(None, base, None, None, None) + rows[0][5:], (None, "a null key stands alone here", None, None, 3) + rows[0][5:]]
    return rows


def embeddings():
    """Rows (vec_id, embedding, label, ...): nulls, non-finite, short and large vectors, ties, a hot vector, repeated ids."""
    rng = np.random.default_rng(9)
    rows = [(int(i), (rng.normal(size=6) / 2).tolist(), int(rng.integers(0, 10))) for i in rng.permutation(500)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.0, 0.0], i % 3) for i in range(200)]
    rows += [(200, [1.0, 1.0], 1), (300, [0.0] * 6, 2), (301, [0.0] * 6, 3), (302, [0.0] * 6, 2), (-100, [0.25] * 6, 4),
             (600, None, 1), (700, [0.1] * 6, None), (800, [0.1, None, 0.1], 1), (900, [float("nan")] * 6, 1),
             (901, [float("inf")] * 6, 1), (None, [0.5] * 6, 1), (2000, [], 1), (2100, [3e38] * 6, 5), (2101, [2e9] * 6, 5),
             (2102, [-3e38] * 6, 6), (5, [0.5] * 6, 1), (5, [0.5] * 6, 1), (100, [0.3] * 6, 7)]
    return [r + (0.5, 1, 2, 3) for r in rows]


def write(spark, folder, docs=None, labels=None, pages=None, vectors=None):
    spark.createDataFrame(docs if docs is not None else [], DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels if labels is not None else [], LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(pages if pages is not None else [], PAGES).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(vectors if vectors is not None else [], VECTORS).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def toxic_labels(docs):
    return [(d[0], 1, int("ka" in (d[1] or ""))) for d in docs if d[0] is not None][::2] + [(None, 1, 1), (3, None, None)]
