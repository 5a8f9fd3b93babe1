"""Vector codes, token counts and hard negatives against brute force."""

import collections
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamlog.llm import hard_negatives, queries, token_counts, vector_codes
from tests.llm.conftest import edge_vectors, prose, read
from tests.llm.test_corpus_queries import CORPORA, folder

NULL_LAST = 1 << 70


def table(spark, sf_dir):
    return [tuple(r)[:3] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def usable(rows):
    """(id, integers, label) of rows whose vector counts."""
    whole = [(k, v, x) for k, v, x in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = collections.Counter(len(v) for _, v, _ in whole)
    dim = max(lengths, key=lambda n: (lengths[n], n), default=0)
    return [(k, tuple(math.floor(256 * c) for c in v), x) for k, v, x in whole if len(v) == dim]


def brute_codes(rows, parts=16, entries=64, rounds=2):
    rows = sorted(usable(rows), key=lambda r: (NULL_LAST if r[0] is None else r[0], r[1]))
    width = len(rows[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((far(v[p], c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            held = collections.defaultdict(list)
            for v in cut:
                held[near(v, p)[1]].append(v[p])
            for e, own in held.items():
                books[p][e] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    out = []
    for (k, _, label), v in zip(rows, cut, strict=True):
        found = [near(v, p) for p in range(parts)]
        out.append((k, label, bytes(e for _, e in found), sum(d for d, _ in found)))
    return out, books


@pytest.mark.parametrize("corpus", CORPORA)
def test_op11(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    wanted, books = brute_codes(table(spark, sf_dir))
    by_label = collections.Counter()
    for _, label, _, error in wanted:
        by_label[label] += error
    sha = vector_codes.books_sha256(np.array(books))
    got = [tuple(r) for r in queries.op11_vector_codes(spark, sf_dir).collect()]
    assert sorted(map(repr, got)) == sorted(repr((k, c.hex(), e, by_label[x], sha)) for k, x, c, e in wanted)


@pytest.mark.parametrize("scale", [1, 40, 1 << 20])
def test_bounds_change_nothing(scale):
    """Codes with bounds equal a full search in every round, scan less, and lie below the true distances."""
    draw = np.random.default_rng(scale)
    x = (draw.normal(size=(400, 2, 3)) * 40 * scale).astype(np.int64) // scale * scale
    book = x[:21].transpose(1, 0, 2).copy()
    history = [book]
    search = vector_codes.Search(history)
    code, low, stamp = search.first(x)
    for t in range(1, 6):
        history = [*history, history[-1] + draw.integers(-3, 4, book.shape) * scale * (draw.random((2, 21, 1)) < 0.3)]
        search = vector_codes.Search(history)
        error = search.again(x, code, low, stamp)
        d = ((x[:, :, None] - history[-1][None]) ** 2).sum(3)
        assert (code == d.argmin(2)).all() and (error == d.min(2)).all()
        assert search.scanned < 0.8 * d.size
        for p in range(2):
            for g in range(search.groups):
                entries = np.arange(g * 8, min(g * 8 + 8, 21))
                then = np.array([history[s][p, entries] for s in stamp[:, p, g]])
                true = ((x[:, p, None] - then) ** 2).sum(2)
                true = np.where(entries == code[:, p, None], 1 << 60, true).min(1)
                assert (vector_codes._bound(low[:, p, g]) ** 2 <= true).all()
    assert len(np.unique(stamp)) > 2  # bounds of several rounds live side by side


def test_net_displacement_is_tighter_than_drift():
    there, back = np.full((1, 8, 2), 5), np.zeros((1, 8, 2), np.int64)
    assert vector_codes.Search([back, there, back]).moved[0].max() == 0 < vector_codes.Search([back, there]).moved[0].max()


def test_codes_refuse_what_would_be_wrong(spark):
    one = spark.createDataFrame([(1, [1.0] * 30, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.encode(one)
    large = spark.createDataFrame([(1, [1e30] * 32, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="reaches"):
        vector_codes.encode(large)


def whole_counts(texts):
    encode = token_counts._tokenizer(queries.tokenizer_path("byte_bpe_50k.json")).encode
    return [len(encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("corpus", CORPORA)
def test_op12(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    docs = read(spark, sf_dir)
    counts = whole_counts(r[1] for r in docs)
    wanted = [(d, len((t or "").encode()), n, n > 1024) for (d, t, *_), n in zip(docs, counts, strict=True)]
    got = [tuple(r) for r in queries.op12_token_counts(spark, sf_dir).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


LONG = [
    prose(11, 300_000), "x" * 300_000, "漢字。かな、カナ！" * 30_000, "a1" * 100_000, " " * 100_000 + "a", "it's <|endoftext|> 'll" * 20_000,
    "<|endoftext|>" * 20_000, "\n\t\x1c é " * 40_000, "e.g., (see: no. 7)!?" * 20_000, "'" * 70_000 + "s t",
]


def test_long_texts(spark):
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id int, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, queries.tokenizer_path("byte_bpe_50k.json")).collect()}
    assert [got[k] for k in range(len(LONG))] == whole_counts(LONG)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from([
    "a", "Z", "é", "漢", "1", "٣", " ", "  ", "\n", "\t", "\x1c", " ", " ", "'", "'s", "'ll", "s", "ll", ".", ",", "。", "<", "|", ">",
    "<|endoftext|>", "<|end", "oftext|>", "́", "😀", "ß",
])))
def test_pieces_keep_the_count(parts):
    text = "".join(parts)
    for size in (1, 3):
        cut = list(token_counts.pieces(text, size))
        assert "".join(cut) == text
        assert sum(whole_counts(cut)) == whole_counts([text])[0]


def test_batches_are_balanced():
    texts = ["word " * n for n in (1, 50_000, 2, 3, 400_000, 1)]
    sizes = [sum(map(len, parts)) for _, parts in token_counts.batches_of(iter(texts), 100_000, 10_000)]
    assert all(100_000 <= n <= 110_010 for n in sizes[:-1]) and sum(sizes) == sum(map(len, texts))


def brute_negatives(rows, every=50, positives=5, negatives=3, move=True):
    rows = [(k, v, (x + 1) % 10 if move and k is not None and k % 7 == 0 else x) for k, v, x in usable(rows) if x is not None]
    q = np.array([v for _, v, _ in rows], object).reshape(len(rows), -1)
    out = []
    for k, v, x in rows:
        if k is None or k % every:
            continue
        score = [int(s) for s in q.dot(np.array(v, object))] if len(v) else [0] * len(rows)
        ranked = sorted((-s, NULL_LAST if r[0] is None else r[0], r[0], r[2]) for s, r in zip(score, rows, strict=True) if r[0] != k)
        for p in [r for r in ranked if r[3] == x][:positives]:
            fits = [r for r in ranked if r[3] != x and 50 * -p[0] <= 100 * -r[0] <= 95 * -p[0]][:negatives]
            out += [(k, p[2], n, r[2], -p[0], -r[0]) for n, r in enumerate(fits, 1)]
    return out


@pytest.mark.parametrize("corpus", CORPORA)
def test_op13(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    wanted = brute_negatives([(k, v, x) for k, v, x in table(spark, sf_dir)])
    got = [tuple(r) for r in queries.op13_hard_negatives(spark, sf_dir).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted)) and wanted


def test_negatives_in_many_blocks(spark):
    """Several blocks of anchors and larger components give the same rows."""
    rows = [(k, [40.0 * c for c in v] if v and None not in v else v, x) for k, v, x in edge_vectors()]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    rows = [tuple(r) for r in docs.collect()]
    found = hard_negatives.mine(docs, docs.vec_id % 10 == 0, block=32 * 6)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute_negatives(rows, every=10, move=False)))


@pytest.mark.parametrize("dim, most", [(1, 0), (3, 1), (64, 160), (64, 1 << 22), (200, 1 << 20), (1000, 7)])
def test_residues_give_exact_scores(dim, most):
    draw = np.random.default_rng(dim)
    a, b = draw.integers(-most, most + 1, (40, dim)), draw.integers(-most, most + 1, (70, dim))
    a[0], b[0], b[1] = most, most, -most
    r = hard_negatives.Residues(dim, most)
    assert (r.scores(r.split(a), r.split(b)) == a @ b.T).all()
    assert len(r.primes) * 10 >= (2 * r.bound).bit_length() - 10


def test_best_keeps_ties_by_id():
    for bound in (10, 1 << 51):
        best = hard_negatives.Best(2, 3, bound)
        score = np.array([[5, 5, 5, 5, 1], [hard_negatives.LEAST, 2, hard_negatives.LEAST, 9, 9]])
        best.add(np.arange(2), score, np.array([4, 6, 8, 10, 12]))
        best.add(np.arange(2), np.array([[5, 7], [2, hard_negatives.LEAST]]), np.array([5, 20]))
        assert best.id.tolist() == [[20, 4, 5], [10, 12, 5]] and best.score.tolist() == [[7, 5, 5], [9, 9, 2]]
