"""Kernels of the corpus operators, each against a plain version."""

import base64
import gzip
import random
import re
import time
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streamlog.llm import (
    components, exact_dedup, iblt, language_id, license_scan, maxent_lm, packing, simhash, substring_dedup, warc, wordhash,
)
from streamlog.llm.suffix_automaton import SuffixAutomaton


def archive(n, zipped):
    records = [warc.record_bytes("response", warc.record_id(k), f"http://h/{k}", b"payload %d\r\n" % k * 20, warc.digest_of(b"payload %d\r\n" % k * 20), None) for k in range(n)]
    return [gzip.compress(r) for r in records] if zipped else records


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "length", "none"])
def test_salvage_recovers_all_later_records(zipped, damage):
    records = archive(9, zipped)
    hurt = bytearray(records[4])
    if damage == "flip":
        hurt[len(hurt) // 2] ^= 0xFF
    elif damage == "cut":
        hurt = hurt[: len(hurt) // 2]
    elif damage == "junk":
        hurt = b"\x1f\x8b\x08 junk WARC/1.1\r\nno header" + bytes(hurt)
    elif damage == "length" and not zipped:
        hurt = hurt.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    data = b"".join([*records[:4], bytes(hurt), *records[5:]])
    rows = list(warc.parse(data))
    whole = damage in ("none", "junk") or (damage == "length" and zipped)
    ids = [warc.row_id(r["record_id"]) for r in rows if r["kind"] == "record"]
    assert ids == [k for k in range(9) if k != 4 or whole]
    gaps = [r for r in rows if r["kind"] == "gap"]
    assert bool(gaps) == (damage not in ("none",) and not (damage == "length" and zipped))
    covered = sorted((r["offset"], r["offset"] + r["length"]) for r in rows)
    assert covered[0][0] == 0 and all(a[1] == b[0] for a, b in pairwise(covered)) and covered[-1][1] == len(data)


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("damage", ["flip", "junk", "length", "cut", "deflate", "crc"])
def test_salvage_inside_a_member(damage, level):
    records = archive(40, False)
    hurt = bytearray(records[20])
    if damage == "flip":
        hurt[-10] ^= 0xFF
    elif damage == "junk":
        hurt = bytearray(b"no header\r\nWARC/1.1\r\nnor here")
    elif damage == "length":
        hurt = hurt.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    member = bytearray(gzip.compress(b"".join([*records[:20], bytes(hurt), *records[21:]]), level))
    wanted = [k for k in range(40) if k != 20]
    if damage == "cut":
        del member[len(member) // 2:]
    elif damage == "deflate":
        member[len(member) // 2] ^= 0xFF
    elif damage == "crc":
        member[-5] ^= 0xFF
    rest = gzip.compress(archive(42, False)[41])
    data = bytes(member) + rest
    rows = list(warc.parse(data))
    ids = [warc.row_id(r["record_id"]) for r in rows if r["kind"] == "record"]
    gaps = [r for r in rows if r["kind"] == "gap"]
    assert len(gaps) >= 1 and gaps[0]["offset"] == 0 and ids[-1] == 41 and len(ids) == len(set(ids))
    if damage in ("flip", "junk", "length"):
        assert ids == [*wanted, 41]
        assert all((r["offset"], r["length"]) == (0, len(member)) for r in rows[:-1])
    elif damage == "crc":
        assert ids == [*range(40), 41]
    else:
        assert ids[:10] == list(range(10))
    # Every byte of the archive is in some row.
    assert {b for r in rows for b in range(r["offset"], r["offset"] + r["length"])} == set(range(len(data)))


def test_digests_in_hex():
    (record,) = archive(1, False)
    digests = {d for d in re.findall(rb"sha1:([A-Z2-7]{32})", record)}
    for upper in (False, True):
        told = record
        for d in digests:
            value = base64.b32decode(d).hex()
            told = told.replace(d, (value.upper() if upper else value).encode())
        (row,) = warc.parse(told)
        assert row["kind"] == "record" and row["payload_digest"] == next(iter(warc.parse(record)))["payload_digest"]
        (row,) = warc.parse(told.replace(b"payload 0", b"payload 1", 1))
        assert row["kind"] == "gap"


def test_hostile_headers_are_quarantined():
    good = archive(3, False)
    for digits in (b"9" * 5000, b"9" * 19, b"0" * 5000 + b"1"):
        hurt = re.sub(rb"Content-Length: \d+", b"Content-Length: " + digits, good[1])
        rows = list(warc.parse(good[0] + hurt + good[2]))
        assert [warc.row_id(r["record_id"]) for r in rows if r["kind"] == "record"] == [0, 2] and any(r["kind"] == "gap" for r in rows)
    assert warc.row_id("<urn:uuid:not-one>") is None and warc.row_id("http://elsewhere/1") is None


@pytest.mark.parametrize("noise", [b"WARC/1.1\r\nA: b\r\n", b"WARC/1.1\r\n", b"A: b\r\n" * 1000 + b"WARC/1.0\n"])
def test_search_after_damage_is_linear(noise):
    good = archive(2, False)
    junk = noise * (3_000_000 // len(noise))
    began = time.process_time()
    rows = list(warc.parse(good[0] + junk + good[1]))
    assert time.process_time() - began < 20
    assert [warc.row_id(r["record_id"]) for r in rows if r["kind"] == "record"] == [0, 1]


def test_record_ids_carry_row_ids():
    for n in (None, 0, 1, -1, 2**63 - 1, -(2**63), 123456789):
        assert warc.row_id(warc.record_id(n)) == n


def test_warc_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"u{k}", "x" * k) for k in range(50)], "a long, b string, c string")
    for zipped in (True, False):
        path = f"{tmp_path}/{zipped}"
        warc.write(pages, path, "a", "b", "c", archive_bytes=2000, gzip=zipped)
        rows = warc.read(spark, path).collect()
        assert {r["kind"] for r in rows} == {"record"} and sorted(len(r["payload"]) for r in rows) == list(range(50))
        assert len({r["path"] for r in rows}) > 3


def test_index_keeps_earlier_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(f"{tmp_path}/index", 8)
    rows = lambda *x: spark.createDataFrame(x, "doc_id long, text string")
    one = exact_dedup.deduplicate(rows((1, "a b"), (2, "ab"), (3, "c")), index, "first").collect()
    two = exact_dedup.deduplicate(rows((0, "a  b"), (5, "d"), (6, "d")), index, "second").collect()
    again = exact_dedup.deduplicate(rows((0, "a  b"), (5, "d"), (6, "d")), index, "second").collect()
    answer = lambda found: {(r["doc_id"], r["keep_id"], r["kept"]) for r in found}
    assert answer(one) == {(1, 1, True), (2, 1, False), (3, 3, True)}
    assert answer(two) == answer(again) == {(0, 1, False), (5, 5, True), (6, 5, False)}
    plan = index.attach(spark, rows((1, "")).schema["doc_id"].dataType)
    assert plan.count() == 3


def test_a_replay_decides_alike_wherever_rows_lie(spark, tmp_path):
    index = exact_dedup.DigestIndex(f"{tmp_path}/index", 8)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    docs = docs.unionByName(docs.where("doc_id < 20"))  # repeated rows
    runs = [exact_dedup.deduplicate(docs.repartition(n), index, "same").collect() for n in (1, 7, 3)]
    answers = [sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in run) for run in runs]
    assert answers[0] == answers[1] == answers[2] and sum(a[3] for a in answers[0]) == 50
    stays = exact_dedup.keep_first(docs.repartition(5), index, "same")
    assert sorted(r["doc_id"] for r in stays.collect()) == list(range(50))
    assert exact_dedup.keep_first(docs, index, "later").count() == 0
    plan = stays._jdf.queryExecution().optimizedPlan().toString() + stays._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_near_copies_are_told_apart_by_text_too(spark):
    other = "quite another text about rivers and the mills beside them"
    text = "one text about a long road through the hills and down again to the sea"
    rows = [(1, text), (2, text + " "), (2, other), (None, text), (None, "lonely words without an id"), (3, None), (4, "")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in kept} == {(1, text), (2, other), (None, "lonely words without an id"), (3, None)}


def test_templates_with_optional_and_replaced_wording():
    machine = license_scan.compile_templates({
        "t": 'start here <<beginOptional>>maybe <<beginOptional>>really<<endOptional>> so<<endOptional>> <<var;name="x";words=1-2>> end'
    })
    match = lambda text: bool(machine.run(license_scan.words(text.encode()), 0))
    assert all(map(match, ["START here, any end", "start here one two end", "start here maybe so x end", "start here maybe really so x y end more"]))
    assert not any(map(match, ["start here end", "start here a b c end", "start there x end", "start here maybe really x y z end", "start here x"]))


def naive_labels(text, templates):
    """Labels and the longest match in words, by one regular expression over whole words for each template."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    spaced, found, longest = "".join(w + " " for w in words), set(), 0
    starts = [0, *(m.end() for m in re.finditer(" ", spaced))]
    for label, template in templates.items():
        pattern = ""
        for k, piece in enumerate(re.split("<<([^>]*)>>", template)):
            if k % 2 == 0:
                pattern += "".join(re.escape(w) + " " for w in re.findall("[a-z0-9]+", piece.lower()))
            elif piece.startswith("var"):
                pattern += r"(?:\S+ ){" + ",".join(re.search(r"words=(\d+)-(\d+)", piece).groups()) + "}"
            else:
                pattern += "(?:" if piece == "beginOptional" else ")?"
        for at in starts:
            # Greedy matches need not be the longest: every end is asked for.
            for end in (e for e in starts if e > at and re.match(pattern, spaced[at:e])) if re.match(pattern, spaced[at:]) else ():
                if re.fullmatch(pattern, spaced[at:end]):
                    found.add(label)
                    longest = max(longest, spaced[at:end].count(" "))
    return ",".join(sorted(found)), longest


def spelled_out(template, draw):
    """A text that the template accepts."""
    while "<<beginOptional>>" in template:
        keep = draw.random() < 0.5
        template = re.sub(r"<<beginOptional>>([^<]*)<<endOptional>>", lambda m: m[1] if keep else " ", template, count=1)
    some = lambda m: " ".join(draw.choice(["Åke", "others", "inc", "7"]) for _ in range(draw.randint(int(m[1]), int(m[2]))))
    return re.sub(r"<<var[^>]*words=(\d+)-(\d+)>>", some, template)


def test_license_labels_against_a_naive_matcher(spark):
    draw, texts, whole = random.Random(11), ["", None, "the the the"], []
    templates = license_scan.BASE | license_scan.TEMPLATES
    for label, template in license_scan.TEMPLATES.items():
        for _ in range(2):
            text = spelled_out(template, draw)
            whole.append((len(texts), label))
            texts.append(f"Some words before. {text} And some after.")
            for _ in range(2):  # one word less, more, or other
                words = text.split()
                at = draw.randrange(len(words))
                words[at:at + 1] = draw.choice([[], [words[at], "only"], ["perhaps"]])
                texts.append(" ".join(words))
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(texts):
        labels, longest = naive_labels(text or "", templates)
        assert (got[i]["labels"], got[i]["score"]) == (labels, longest / (longest + 4)), text
    assert all(label in got[i]["labels"].split(",") for i, label in whole)


def test_altered_conditions_lose_the_label(spark):
    mit = spelled_out(license_scan.TEMPLATES["mit"], random.Random(1))
    bsd = spelled_out(license_scan.TEMPLATES["bsd-3-clause"], random.Random(2))
    texts = {
        "Licensed under the Apache License, Version 1.1": "", "Licensed under the Apache License, Version 2.0.": "apache-2.0-reference",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0-reference", "Licensed under CC BY 4.0.": "cc-by,cc-by-4.0-reference",
        mit: "mit", mit.replace("copies of the Software,", "copies of the Software, but only on Sundays,"): "",
        mit[:mit.index("THE SOFTWARE IS")]: "", mit + " " + bsd: "bsd-3-clause,mit", bsd.replace("source and binary", "source"): "",
    }
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == [",".join(sorted(x.split(","))) for x in texts.values()]


def test_pivot_buckets_and_flips_agree(spark):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    prints = {centre} | {draw.getrandbits(64) for _ in range(200)}
    for _ in range(300):
        prints.add(draw.choice(sorted(prints)) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64))
    for a in range(30):
        prints.add(centre ^ 1 << a)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    group = {x: x for x in signed}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                group[max(top(a), top(b))] = min(top(a), top(b))
    wanted = {x: top(x) for x in signed if top(x) != x}
    for bucket in (2, 512):
        found = {r["node"]: r["root"] for r in components.components(simhash.links(df, bucket)).collect()}
        assert found == wanted


def test_sum_of_squares_fills_sequences():
    draw = random.Random(1)
    sizes = sorted((min(2048, int(draw.expovariate(1 / 400)) + 1) for _ in range(3000)), reverse=True)
    bins = packing.fill(sizes)
    used = np.bincount(bins, sizes)
    assert used.max() <= 2048 and len(used) <= sum(sizes) / 2048 * 1.01 + 1


def test_small_groups_are_packed_again(spark):
    rows = spark.createDataFrame([(k, 300 + k % 900) for k in range(400)], "k long, length long")
    got = packing.assign(rows, group_pieces=50).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
    assert got["sequence_id"].nunique() <= got["length"].sum() / 2048 * 1.15 + 1


def test_packing_ends_when_nothing_is_saved(spark):
    rows = spark.createDataFrame([(k, 1025) for k in range(300)], "k long, length long")
    got = packing.assign(rows, group_pieces=50).toPandas()
    assert got["sequence_id"].nunique() == 300 and not got["offset"].any()


def test_packing_goes_on_past_a_few_rounds(spark):
    """Groups of four are dealt again until a round saves nothing."""
    rows = spark.createDataFrame([(k, 1) for k in range(2048)], "k long, length long")
    got = packing.assign(rows, group_pieces=4).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert got["sequence_id"].nunique() == 1
    assert sorted(got["offset"]) == list(range(2048))


def test_matching_statistics():
    draw = random.Random(3)
    for _ in range(30):
        passages = [[draw.choice("abc") for _ in range(draw.randint(0, 25))] for _ in range(4)]
        automaton = SuffixAutomaton()
        for p in passages:
            automaton.add(p)
        held = {tuple(p[i:j]) for p in passages for i in range(len(p)) for j in range(i, len(p) + 1)} | {()}
        text = [draw.choice("abcd") for _ in range(60)]
        wanted = [max(n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in held) for i in range(len(text))]
        assert list(automaton.statistics(text)) == wanted
        for p in [*passages, text, text[:9]]:
            for width in (1, 3, 9):
                told = list(automaton.statistics(p))[width - 1:]
                assert automaton.holds_windows(p, width) == all(n >= width for n in told)


def test_word_hashes_depend_on_words_only():
    data = b"  aa b aa\tccc\x0bb aa " + b"x" * 3_000_000 + b" aa"
    starts, ends = wordhash.spans(data)
    words = [data[a:b] for a, b in zip(starts, ends, strict=True)]
    assert words == data.split()
    found = wordhash.hashes(data, starts, ends).tolist()
    assert len(set(found)) == len(set(words)) == len(set(zip(found, words, strict=True)))


def test_sketches_recover_differences():
    draw = random.Random(2)
    known = iblt._Words()
    base = [draw.choice("abcdefgh") * draw.randint(1, 9) for _ in range(900)]
    other = base[:700] + ["new"] * 5 + base[760:]
    texts = [" ".join(base).encode(), " ".join(other).encode(), b"", b"one\none\none", b"one\none"]
    digest, sizes = iblt.digests(texts, known)
    parts = np.split(digest, np.cumsum(sizes)[:-1])
    for a in range(len(texts)):
        for b in range(len(texts)):
            one, two = set(parts[a].tolist()), set(parts[b].tolist())
            got = iblt.likeness(digest, sizes, np.array([a]), np.array([b]))[0]
            assert got == (len(one & two) / len(one | two) if one | two else 1.0)
    assert len(set(parts[3].tolist())) == 3


@pytest.mark.parametrize("heads", [16, maxent_lm.HEADS])
def test_words_of_a_leaf_add_up_to_one(spark, heads):
    """A leaf with far more words than a fixed share for each would allow, as tail and as heads."""
    n = 50_000
    words = [f"w{k}ab" for k in range(n)]
    docs = spark.createDataFrame([(0, " ".join(words)), (1, "w1ab w2ab w2ab")], "doc_id long, text string")
    model, total = maxent_lm.find_heads(docs, "text", heads)
    maxent_lm.count_leaves(docs, "text", model)
    maxent_lm.train(docs, "text", model)
    asked = [*words, "neverab"]
    both = docs.selectExpr("doc_id - 2 AS doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"))
    score = {r["doc_id"]: r["score"] for r in maxent_lm.score(both, model, total, F.col("doc_id") >= 0).collect()}
    t = maxent_lm.tokens(pa.array([w.encode() for w in asked], pa.binary()))
    _, leaf = maxent_lm.lookup(model, t)
    path = np.zeros(len(leaf))
    for part, _, _, digit, logs in maxent_lm._slices(model, t, leaf):
        path[part] += logs[np.arange(len(digit)), digit] / np.log(10)
    path = np.bincount(t.doc, path)
    first = leaf[t.first]
    shared = np.flatnonzero(first >= maxent_lm.OWN_LEAVES)
    assert len(shared) > 40_000 and len(set(first[shared])) == 1
    assert np.isclose(sum(10.0 ** (score[k] - path[k]) for k in shared.tolist()), 1.0, rtol=1e-6)


def test_texts_of_a_batch_are_hashed_as_one(monkeypatch):
    """One call for all texts, and the same tokens as each text has alone."""
    texts = [b"", b"One two  one", b" \t", b"\x0bthree ONE ", "\u00c9t\u00e9 a\u00a0b".encode(), b"x", b"", b"y" * 70, b""]
    alone = [maxent_lm.tokens(pa.array([t], pa.binary())) for t in texts]
    calls, hashes = [], wordhash.hashes
    monkeypatch.setattr(wordhash, "hashes", lambda *a: calls.append(1) or hashes(*a))
    for batch in (pa.array(texts, pa.binary()), pa.array([b"left out", *texts], pa.binary())[1:]):
        calls.clear()
        t = maxent_lm.tokens(batch)
        assert len(calls) == 1
        assert t.word.dtype == np.uint64 and t.word.tolist() == np.concatenate([x.word for x in alone]).tolist()
        assert t.shared.tolist() == np.concatenate([x.shared for x in alone]).tolist()
        sizes = [1 + len(x.split()) for x in texts]
        assert t.doc.tolist() == np.repeat(np.arange(len(texts)), sizes).tolist()
        assert t.first.tolist() == (np.cumsum(sizes) - sizes).tolist()


def test_gradient_adds_up_token_by_token():
    draw = np.random.default_rng(4)
    t = maxent_lm.tokens(pa.array([" ".join(f"w{k}" for k in draw.zipf(1.5, 40) % 30).encode() for _ in range(5)], pa.binary()))
    heads = np.unique(t.word)[::2]
    for known in (heads, heads[:0]):
        assert maxent_lm._search(known, t.word).tolist() == np.searchsorted(known, t.word).tolist()
    model = maxent_lm.Model(heads, np.where(np.arange(len(heads)) < maxent_lm.OWN_LEAVES, np.arange(len(heads)), -1))
    _, leaf = maxent_lm.lookup(model, t)
    model.leaf_counts = np.bincount(leaf, minlength=maxent_lm.LEAVES)
    model.weights = draw.normal(0, 0.3, (2, 1 << maxent_lm.BITS, maxent_lm.CLASSES)).astype(np.float32)
    total = np.zeros((2, maxent_lm.CLASSES + 1, 1 << maxent_lm.BITS))
    maxent_lm.add_gradient(model, t, total)
    wanted, bias = np.zeros_like(total), model.biases().astype(np.float64)
    features = maxent_lm._rows(t)
    for k, (high, low) in enumerate(zip(*np.divmod(leaf, maxent_lm.CLASSES), strict=True)):
        for level, parent, digit in ((0, maxent_lm.CLASSES, high), (1, high, low)):
            rows = [r[0] for r in maxent_lm._level([f[k:k + 1] for f in features], np.array([parent]))]
            logits = bias[0 if level == 0 else parent + 1] + sum(model.weights[level][r].astype(np.float64) for r in rows)
            chance = np.exp(logits) / np.exp(logits).sum()
            for r in rows:
                wanted[level, :, r] += np.append((np.arange(maxent_lm.CLASSES) == digit) - chance, 1)
    assert np.allclose(total, wanted, atol=1e-4)


def test_documents_stay_whatever_the_probability(spark):
    """Five languages with the same words: none has more than a fifth."""
    docs = spark.createDataFrame([(k, "same words", f"l{k}") for k in range(5)] + [(5, "12 34", "l0"), (6, None, "l1")],
                                 "doc_id long, text string, lang string")
    kept = language_id.keep_identified(docs, language_id.fit(docs.where("doc_id < 5")))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_number_signs_are_no_letters():
    model = (["de", "en"], np.zeros(((1 << language_id.BITS) + 1, 2), np.float32), np.zeros(2))
    names, _ = language_id.rate(["½ ² ① Ⅷ", "12 _-", "½ x", "ª", "漢", None, ""], model)
    assert [n == "und" for n in names] == [True, True, False, False, False, True, True]


def test_substrings_in_small_ranges_and_shards(spark, monkeypatch):
    """Many ranges, many shards, a passage that most documents repeat; only automata decide."""
    monkeypatch.setattr(substring_dedup, "PART_WORDS", 300)
    draw = random.Random(8)
    hot = " ".join(draw.choices("abcdefghij", k=90))
    texts = []
    for k in range(60):
        own = " ".join(f"w{draw.randrange(5000)}" for _ in range(draw.randrange(5, 80)))
        texts.append(f"{own} {hot if k % 3 else hot[20:150]} {own if k % 7 == 0 else ''}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    seen, gone = set(), {}
    for k, text in enumerate(texts):
        words, cover = text.split(), set()
        for at in range(len(words) - 19):
            window = tuple(words[at:at + 20])
            if window in seen:
                cover |= set(range(at, at + 20))
            seen.add(window)
        gone[k] = [w for i, w in enumerate(words) if i not in cover]
    got = substring_dedup.deduplicate(docs, range_bytes=2000).collect()
    assert {r["doc_id"]: r["kept"].split() for r in got} == gone
    assert all(r["n_removed"] == sum(b - a for a, b in r["removed"]) == r["n_words"] - len(gone[r["doc_id"]]) for r in got)


def test_without_a_reference_nothing_is_removed(spark):
    """Proposed spans whose reference the automaton does not hold are misses, not removals."""
    rows = [(1, 0, 5, 9, 0, False, b" ".join(b"x%d" % k for k in range(30)), 30), (9, 0, 0, 9, 0, True, b" ".join(b"x%d" % k for k in range(4, 28)), 24)]
    found = spark.createDataFrame(rows, "doc_id long, mark long, at long, key_id long, key_mark long, is_ref boolean, passage binary, n_words long")
    got = substring_dedup.matched(found, 20).collect()
    assert {tuple(r) for r in got} == {(1, 0, 9, 33, 0), (1, 0, 0, 0, 6)}
