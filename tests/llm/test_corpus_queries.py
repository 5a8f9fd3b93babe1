"""Queries against SQL and against brute force, on the edge tables and on a small corpus."""

import base64
import collections
import hashlib
import math
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from streamlog.llm import license_scan, packing, queries
from tests.llm.conftest import read

SMALL = "/root/testdata/sf0.001"
CORPORA = ["edges", "small"]


def folder(name, edge_dir):
    if name == "edges":
        return edge_dir
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL


def run(spark, name, sf_dir):
    (fn,) = [f for n, f in queries.QUERIES.items() if n.startswith(name + "_")]
    return [r.asDict() for r in fn(spark, sf_dir).collect()]


def parquet(sf_dir, table):
    path = Path(f"{sf_dir}/{table}.parquet")
    return str(path / "*.parquet") if path.is_dir() else str(path)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_table(spark, empty_dir, name):
    assert queries.QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    sf_dir = folder("small", None)
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{parquet(sf_dir, table)}'")
    got = queries.QUERIES[name](spark, sf_dir)
    wanted = db.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_op1_edges(spark, edge_dir):
    pages = read(spark, edge_dir, "pages")
    first = collections.defaultdict(list)
    for page in pages:
        first[page[2] or ""].append(page[0])
    wanted = []
    for page, _, html, *_ in pages:
        own = [x for x in first[html or ""] if x is not None]
        top = max(own) if own else None
        data = (html or "").encode()
        revisit = len(first[html or ""]) > 1 and page != top
        wanted.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                       "revisit" if revisit else "response", top if revisit else None))
    got = [tuple(r.values()) for r in run(spark, "op1", edge_dir)]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_op2_edges(spark, edge_dir):
    docs = read(spark, edge_dir)
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in docs]
    groups = collections.defaultdict(list)
    for (doc, text, *_), n in zip(docs, norm, strict=True):
        groups[n].append((-len(text or ""), doc is None, doc if doc is not None else 0, doc))
    got = run(spark, "op2", edge_dir)
    assert len(got) == len(docs)
    of = {hashlib.sha256(n.encode()).hexdigest(): (min(g)[3], len(g)) for n, g in groups.items()}
    assert all((r["keep_id"], r["group_size"]) == of[r["text_sha256"]] for r in got)
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == collections.Counter(of.keys())
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


@pytest.mark.parametrize("corpus", CORPORA)
def test_op3(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    wanted = collections.Counter()
    for doc, text, *_ in read(spark, sf_dir):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places, labels = [], set()
        for label, phrase in license_scan.BASE.items():
            p = phrase.split()
            for i in range(len(words)):
                if words[i:i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        wanted[doc, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    got = run(spark, "op3", sf_dir)
    assert collections.Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) for r in got) == wanted
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)


@pytest.mark.parametrize("corpus", CORPORA)
def test_op4(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    docs = read(spark, sf_dir)
    got = run(spark, "op4", sf_dir)
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(d for d, *_ in docs)
    text_of = {d: t for d, t, *_ in docs if d is not None}
    for r in got:
        if r["doc_id"] is None:
            continue
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        letters = any(c.isalpha() for c in text_of[r["doc_id"]] or "")
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1
    if corpus == "small":
        lang_of = {d: lang for d, _, lang, _ in docs}
        held = [r for r in got if r["held_out"]]
        assert sum(r["lang_pred"] == lang_of[r["doc_id"]] for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("corpus", CORPORA)
def test_op5(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    docs, counts = read(spark, sf_dir), collections.Counter()
    split = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    for doc, text, *_ in docs:
        if not held(doc):
            counts.update(split(text))
    total, distinct = sum(counts.values()), len(counts)
    wanted = sorted(
        (repr(d), held(d), len(w := split(t)), sum(counts[x] > 0 for x in w), total,
         sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w))
        for d, t, *_ in docs
    )
    got = run(spark, "op5", sf_dir)
    mine = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    for a, b in zip(mine, wanted, strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


@pytest.mark.parametrize("corpus", CORPORA)
def test_op6(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    rows = [(d, src, len((t or "").encode().split()), int(hashlib.md5(("null" if d is None else str(d)).encode()).hexdigest()[:15], 16))
            for d, t, _, src in read(spark, sf_dir)]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    total = {s: sum(r[2] for r in rows if r[1] == s) for s in sources}
    target, budget = {}, 1.5 * sum(total.values())
    open_ = list(sources)
    while open_:  # shares by weight; who is above the limit stops there
        share = {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * total[s]]
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 2.0 * total[s]
            budget -= target[s]
            open_.remove(s)
    got = run(spark, "op6", sf_dir)
    by_source = collections.defaultdict(list)
    for d, s, n, h in rows:
        by_source[s].append((h, d, n))
    wanted = []
    for s, own in by_source.items():
        copies = int(target[s] / total[s] + 1e-12) if total[s] else 0
        rest, upto, cut = target[s] - copies * total[s], 0, 0
        for h in sorted({h for h, *_ in own}):
            tied = sum(n for x, _, n in own if x == h)
            if upto + tied <= rest or (tied - (rest - upto) < rest - upto):
                cut = h + 1
            upto += tied
            if upto > rest:
                break
        wanted += [(repr(d), n, total[s], round(target[s], 6), n * (copies + (h < cut))) for h, d, n in own]
    mine = [(repr(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got]
    assert sorted(mine) == sorted(wanted)
    assert sorted(map(repr, run(spark, "op6", sf_dir))) == sorted(map(repr, got))


def brute_simhash(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("corpus", CORPORA)
def test_op7(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    docs = read(spark, sf_dir)
    prints = [brute_simhash(t) for _, t, *_ in docs]
    group = list(range(len(docs)))
    near = np.bitwise_count(np.array(prints, np.uint64)[:, None] ^ np.array(prints, np.uint64)) <= 2
    changed = True
    while changed:
        new = [min(group[j] for j in np.flatnonzero(near[i])) for i in range(len(docs))]
        changed, group = new != group, new
    least = collections.defaultdict(list)
    for (doc, *_), g in zip(docs, group, strict=True):
        least[g] += [] if doc is None else [doc]
    wanted = [(d, f"{p:016x}", min(least[g], default=None)) for (d, *_), p, g in zip(docs, prints, group, strict=True)]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in run(spark, "op7", sf_dir)]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


@pytest.mark.parametrize("corpus", CORPORA)
def test_op8(spark, edge_dir, corpus):
    from tokenizers import Tokenizer

    sf_dir = folder(corpus, edge_dir)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    wanted = collections.Counter()
    for doc, text, *_ in read(spark, sf_dir):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4")
            wanted[doc, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = run(spark, "op8", sf_dir)
    assert collections.Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == wanted
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= 2048
    assert len(bins) <= 1.02 * sum(r["length"] for r in got) / 2048 + 1


def brute_repeats(docs):
    docs = sorted(((d is not None, d or 0, xxhash.xxh64_intdigest((t or "").encode(), 42), (t or "").encode().split()) for d, t, *_ in docs), key=lambda x: (x[0], x[1]))
    seen, out = {}, []
    for has, doc, mark, words in docs:
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            run_ = tuple(words[i:i + 20])
            if seen.setdefault(run_, (doc, mark, i)) != (doc, mark, i):
                gone[i:i + 20] = [True] * 20
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc if has else None, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("corpus", CORPORA)
def test_op9(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    got = [tuple(r.values()) for r in run(spark, "op9", sf_dir)]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_repeats(read(spark, sf_dir))))


@pytest.mark.parametrize("corpus", CORPORA)
def test_op10(spark, edge_dir, corpus):
    sf_dir = folder(corpus, edge_dir)
    docs = sorted(read(spark, sf_dir), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    wanted = collections.Counter()
    for k, (doc, text, *_) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        n = len(text) // 4
        wanted[doc, len(text), hashlib.sha256((text[:len(text) - n] + after[:n]).encode()).hexdigest()] += 1
    got = run(spark, "op10", sf_dir)
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == wanted
    text_of = {d: t or "" for d, t, *_ in docs if d is not None}
    prints = collections.defaultdict(set)
    for r in got:
        if r["doc_id"] is not None:
            prints[text_of[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    if corpus == "small":
        assert np.mean([r["near_edited"] for r in got]) > 0.4 > 0.1 > np.mean([r["near_next"] for r in got])


@pytest.mark.parametrize("corpus", CORPORA)
def test_pipeline(spark, edge_dir, corpus):
    """Every stage against a brute-force version on what the stage before kept."""
    sf_dir = folder(corpus, edge_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
        out = out.persist()
        kept.append((name, [tuple(r) for r in docs.collect()], [r.asDict() if name == "packing" else tuple(r) for r in out.collect()]))
        docs = out
    (_, before, told), (_, _, exact), (_, _, near), (_, _, mixed), (_, _, packed) = kept
    letters = [r for r in before if any(c.isalpha() for c in r[1] or "")]
    assert collections.Counter(told) == collections.Counter(letters)  # some language was learned, so none vanishes
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    assert len(exact) == len({norm(r[1]) for r in told}) == len({norm(r[1]) for r in exact})
    assert set(exact) <= set(told)
    prints = {r: brute_simhash(r[1]) for r in exact}
    assert set(near) <= set(exact)
    values = [(prints[r], r) for r in near if r[0] is not None]
    assert all((a ^ b).bit_count() > 2 for i, (a, _) in enumerate(values) for b, _ in values[:i])
    times = collections.Counter(mixed)
    assert set(times) <= set(near) and max(times.values(), default=1) <= 2
    assert {(r["doc_id"], r["piece"]) for r in packed} and {r["doc_id"] for r in packed} == {r[0] for r in mixed}
    assert sum(r["piece"] == 0 for r in packed) == len(mixed)
