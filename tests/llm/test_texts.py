"""Operators on texts against brute force, and on odd rows."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemart import workspace
from lakemart.llm import bitplane_store, license_join, quality_forest, runlength_dedup, simhash_dedup, token_automaton, toxicity_subword
from lakemart.llm.components import _with_least, components

WORD_FILE, BYTE_FILE = "/opt/tokenizers/word_bpe_49k.json", "/opt/tokenizers/byte_bpe_50k.json"


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def library(file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file)


# Encoding


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_automaton_encodes_and_decodes_as_the_library(table, request):
    docs, known = request.getfixturevalue(table), library(WORD_FILE)
    want = Counter()
    for doc_id, text in texts_of(docs):
        ids = known.encode(text, add_special_tokens=False).ids
        decoded = known.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(map(tuple, token_automaton.digests(docs, WORD_FILE).collect())) == want


def test_automaton_accepts_only_what_the_merges_make():
    # a=0 b=1 c=2, ab=3, abc=4, aa=5
    automaton = token_automaton.Automaton([(0, 1, 3), (3, 2, 4), (0, 0, 5)])
    assert not automaton.step(0, 1) and not automaton.step(3, 2) and not automaton.step(0, 4 - 4)
    assert automaton.step(5, 0) and not automaton.step(0, 5) and automaton.step(1, 0)
    assert automaton.step(0, 3) and automaton.step(0, 4)  # aab is a ab: the merge of ab comes first


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_bitplane_files_give_the_ids_back(table, request):
    docs, known = request.getfixturevalue(table), library(BYTE_FILE)
    got = bitplane_store.store_and_check(docs, BYTE_FILE).collect()
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*known.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


@pytest.mark.parametrize("plane_bits", [1, 8])
def test_planes_round_trip(plane_bits):
    for ids in (np.zeros(5, np.uint32), np.arange(70_000, dtype=np.uint32), np.array([2**32 - 1, 0, 7], np.uint32)):
        assert (bitplane_store.unpack(bitplane_store.pack(ids, plane_bits), len(ids), plane_bits) == ids).all()


# Quality


def rule_values(text):
    words, windows = re.findall(r"[^\x20\x09-\x0D]+", text), {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_rule_statistics(table, request, labels):
    docs = request.getfixturevalue(table)
    found = quality_forest.verdicts(docs, labels).collect()
    assert Counter((r["doc_id"], *(r[n] for n in quality_forest.NAMES[:5])) for r in found) == Counter((i, *rule_values(t)) for i, t in texts_of(docs))
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in found)
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_forest_rejects_junk_and_keeps_the_good(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = quality_forest.verdicts(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r["kept"] for r in found if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_keep_good_agrees_with_the_verdicts(documents, labels):
    kept = quality_forest.keep_good(documents, labels)
    assert kept.columns == documents.columns
    want = [r["doc_id"] for r in quality_forest.verdicts(documents, labels).where("kept").collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_no_labels_reject_nothing_beyond_the_rules(documents, labels):
    found = quality_forest.verdicts(documents, labels.limit(0))
    assert found.where("kept = base_failed").count() == 0


# SimHash


def simhash(text, n=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    import xxhash

    parts = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_near_duplicates(table, request):
    docs = request.getfixturevalue(table)
    marks = [(i, simhash(t)) for i, t in texts_of(docs)]
    of = groups({f for _, f in marks}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in marks:
        if i is not None:
            least[of[f]] = min(i, least.get(of[f], i))
    want = Counter((i, f, least.get(of[f])) for i, f in marks)
    got = simhash_dedup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want
    kept = simhash_dedup.first_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(of.values()))


def test_bucket_links_connect_dense_and_sparse_groups():
    random = np.random.default_rng(0)
    base = random.integers(0, 2**63, 6, np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in range(30, 60)] + [base]))
    links = simhash_dedup.bucket_links(fps, 0, 4)
    assert len(links) < len(fps)
    joined = groups(set(map(int, fps.view(np.int64))), lambda a, b: (a, b) in links or (b, a) in links)
    assert len(set(joined.values())) == 6


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (8, 7), (1, 0)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_no_round_of_components_is_broadcast(spark):
    found = _with_least(spark.createDataFrame([(2, 1), (3, 2), (3, 9)], "u bigint, v bigint"))
    assert sorted(map(tuple, found.collect())) == [(2, 1, 1), (3, 2, 2), (3, 9, 2)]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_components_write_half_rounds_and_none_over_stars(spark, monkeypatch):
    plans, write = [], workspace.write_counted
    monkeypatch.setattr(workspace, "write_counted", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, path))
    stars = components(spark.createDataFrame([(3, 1), (1, 4), (9, 8)], "u bigint, v bigint"))
    assert sorted(map(tuple, stars.collect())) == [(1, 1), (3, 1), (4, 1), (8, 8), (9, 8)] and len(plans) == 1
    path = components(spark.createDataFrame([(i, i + 1) for i in range(9)], "u bigint, v bigint"))
    assert {tuple(r) for r in path.collect()} == {(i, 0) for i in range(10)} and len(plans) > 2
    assert max(plan.count("FileScan parquet") for plan in plans) == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_any_links(spark, seed):
    random = np.random.default_rng(seed)
    links = [tuple(map(int, x)) for x in random.integers(-30, 30, (45, 2))]
    joined = groups({x for u, v in links if u != v for x in (u, v)}, lambda a, b: (a, b) in links or (b, a) in links)
    assert dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect())) == joined


# Toxicity


def test_toxicity_finds_held_out_words(spark):
    words = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel"]
    random = np.random.default_rng(1)
    rows = []
    for i in range(400):
        text = list(random.choice(words, 60))
        if i % 4 == 0:
            text[int(random.integers(60))] = "nasty" + str(random.choice(["", "er", "est", "ling", "ish"]))
        rows.append((i, " ".join(text), i % 4 == 0))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "nastyness", ), (9000, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows], "doc_id bigint, toxic int")
    found = {r["doc_id"]: r for r in toxicity_subword.toxicity(docs, labels).collect()}
    assert len(found) == 402 and all(0 <= r["score"] <= 1 for r in found.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)
    held = [(found[i]["predicted"], t) for i, _, t in rows if found[i]["held_out"]]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert found[9000]["predicted"] == 0


def test_toxicity_without_labels_or_rows(odd, empty, labels):
    assert {r["predicted"] for r in toxicity_subword.toxicity(odd, labels.limit(0)).collect()} == {0}
    assert toxicity_subword.toxicity(empty, labels).count() == 0


# Repeated bytes


def removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~mark].tobytes()
        yield len(t), int(mark.sum()), len(runlength_dedup.spans(mark)), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("batch", [runlength_dedup.BATCH, 700])
def test_repeated_bytes(spark, odd, documents, batch):
    docs = [(i, t) for i, t in texts_of(documents)][:120] + [(i, t[:2500]) for i, t in texts_of(odd)]
    docs += [(1000, "a" * 700), (1001, "ab" * 300), (1002, "x" + docs[3][1][40:400] + "y"), (1003, docs[5][1][:80] + "é" + docs[5][1][80:300])]
    # A group larger than an index of 700 bytes: a line that many texts share, and near copies of one text.
    docs += [(2000 + i, f"{i * 7919:x} " * 20 + docs[7][1][:70] + f" {i * 104729:x}" * 20) for i in range(60)]
    docs += [(3000 + i, docs[9][1][:150] + f"{i}" + docs[9][1][150:400]) for i in range(60)]
    got = runlength_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), length=100, batch=batch)
    want = Counter((i, *r) for (i, _), r in zip(docs, removed([t.encode() for _, t in docs], 100), strict=True))
    assert Counter(map(tuple, got.drop("kept").collect())) == want


def test_ranges_within_copies_are_not_multiplied(spark):
    line = "".join(chr(97 + i * i % 26) + str(i * 7919) for i in range(60))
    docs = [(i, 0, line) for i in range(30)] + [(100 + i, 0, line[:150] + f"<{i}>" + line[150:]) for i in range(3)]
    found = runlength_dedup.dedup_spans(spark.createDataFrame(docs, "a bigint, b bigint, text string"), 100)
    rows = Counter(r["a"] for r in found.collect())
    stretches = len(runlength_dedup.stretches(line.encode(), 100)[0])
    assert {rows[i] for i in range(30)} == {stretches}


def test_ranges_of_a_shared_passage_are_not_multiplied(spark):
    """A passage with other neighbours in each text: what the last round finds byte by byte comes as a few ranges a text."""
    passage = "".join(chr(97 + i * i % 26) + str(i * 7919) for i in range(30))[:100]
    docs = [(i, 0, f"{i * 104729:x} " * 20 + f"{i % 5}ab{i % 7}" + passage + f"{i % 6}cd{i % 11}" + f" {i * 7919:x}" * 20) for i in range(1, 121)]
    found = runlength_dedup.dedup_spans(spark.createDataFrame(docs, "a bigint, b bigint, text string"), 100, batch=700).collect()
    gone = {i: set() for i, _, _ in docs}
    for r in found:
        gone[r["a"]] |= set(range(r["from"], r["to"]))
    want = removed([t.encode() for _, _, t in docs], 100)
    assert [len(gone[i]) for i, _, _ in docs] == [n for _, n, _, _ in want]
    assert max(Counter(r["a"] for r in found).values()) <= 6


def test_matching_statistics():
    import random

    pick = random.Random(3)
    for _ in range(40):
        strings = list({bytes(pick.choice(b"ab" if pick.random() < 0.5 else b"abcd") for _ in range(pick.randint(1, 40))) for _ in range(pick.randint(1, 5))})
        places = [(i, p) for i, s in enumerate(strings) for p in range(len(s))]
        for (i, p), got in zip(places, np.concatenate(runlength_dedup.matching_statistics(strings, 5)), strict=True):
            most = max((next(k for k in range(6) if k == 5 or strings[i][p + k : p + k + 1] != strings[j][q + k : q + k + 1] or p + k >= len(strings[i])) for j, q in places if (i, p) != (j, q)), default=0)
            assert min(got, 5) == most


# Licenses


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_licenses(spark, table, request):
    more = "x CC-BY 4\nyy All rights  reserved. cc by\nPermission is granted, free of charge, to any person obtaining a copy of this software and documentation files, to deal in the Software without restriction"
    docs = request.getfixturevalue(table).select("doc_id", "text").union(spark.createDataFrame([(999, more)], "doc_id bigint, text string"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    templates = [(label, set(word.findall(t.lower()))) for label, t in license_join.TEMPLATES]
    lengths = [len(word.findall(t.lower())) for _, t in license_join.TEMPLATES]
    want = Counter()
    for doc_id, text in texts_of(docs):
        words, at, base = word.findall(text.lower()), [], set()
        for phrase, label in license_join.PHRASES.items():
            here = [i for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
            at += here
            base |= {label} if here else set()
        labels, best = set(base), 0.0
        blocks = [set(word.findall(block)) for block in re.split(r"\n|(?<=[.!?])\s", text.lower())]
        for (label, t), n in zip(templates, lengths, strict=True):
            if len(t & set(words)) / len(t) < 0.8 - 1e-9:
                continue
            for own in [*blocks, *(set(words[i : i + n]) for i in range(max(len(words) - n, 0) + 1))]:
                others = [u for other, u in templates if other != label and len(t & u) / len(t) >= 0.8 - 1e-9]
                told = all(t - u <= own and not (t <= u and own & (u - t)) for u in others)
                if len(own & t) / len(t) >= 0.8 - 1e-9 and told:
                    labels.add(label)
                    best = max(best, len(own & t) / len(t))
        want[doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if at else best] += 1
    assert Counter(map(tuple, license_join.license_scan(docs).collect())) == want


@pytest.mark.parametrize("width", [20, 40, 72])
def test_each_license_is_found_wrapped_and_embedded(spark, width):
    around = "the quick fox and a lazy dog. " * 9
    rows = [(i, textwrap.fill(f"{around}# {text} {around}", width)) for i, (_, text) in enumerate(license_join.TEMPLATES)]
    found = license_join.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        label = license_join.TEMPLATES[r["doc_id"]][0]
        assert set(r["labels"].split(",")) == {label, *filter(None, r["base_labels"].split(","))} and r["score"] == 1.0


def test_each_license_sentence_has_its_own_label(spark):
    rows = [(i, f"Some text before. {text} And more\nbehind.") for i, (_, text) in enumerate(license_join.TEMPLATES) if text.count(". ") == 0 or "4.0" in text]
    found = license_join.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert len(found) == len(rows) > 12
    for r in found:
        label = license_join.TEMPLATES[r["doc_id"]][0]
        assert set(r["labels"].split(",")) == {label, *filter(None, r["base_labels"].split(","))}


def test_empty_tables(empty, labels):
    assert quality_forest.verdicts(empty, labels).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert simhash_dedup.first_of_each(empty).count() == 0
    assert token_automaton.digests(empty, WORD_FILE).count() == 0
    assert bitplane_store.store_and_check(empty, BYTE_FILE).count() == 0
    assert runlength_dedup.remove_repeats(empty).count() == 0
    assert license_join.license_scan(empty).count() == 0


@pytest.mark.parametrize("threshold", range(1, 13))
def test_links_at_every_threshold(spark, threshold):
    draw = np.random.default_rng(threshold)
    fps = []
    for base in draw.integers(0, 2**63, 25):
        fps.append(int(base))
        for _ in range(8):
            turned = draw.choice(64, draw.integers(0, threshold + 3), replace=False)
            fps.append(int(base) ^ sum(1 << int(b) for b in turned))
    fps = sorted({x - 2**64 if x >= 2**63 else x for x in fps})
    near = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= threshold}

    def groups(links):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {x: find(x) for x in fps}

    found = [(min(r), max(r)) for r in simhash_dedup.near_links(spark.createDataFrame([(x,) for x in fps], "fp bigint").repartition(3), threshold).collect()]
    assert set(found) <= near and groups(found) == groups(near)


def test_thresholds_beyond_are_refused(documents):
    for threshold in (0, 13):
        with pytest.raises(ValueError, match="threshold"):
            simhash_dedup.near_duplicates(documents, threshold=threshold)


def test_first_of_each_with_clashing_columns(spark):
    rows = [(1, "a b c d e", 7, 8, 9), (1, "a b c d e", 6, 8, 9), (2, "a b c d e", 7, 8, 9), (3, "other words in this one here", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _id int, _fp int, _place int")
    found = [tuple(r) for r in simhash_dedup.first_of_each(docs).orderBy("doc_id").collect()]
    assert [r[0] for r in found] == [1, 3] and found[0] in rows[:2]
    assert found == [tuple(r) for r in simhash_dedup.first_of_each(docs.repartition(3)).orderBy("doc_id").collect()]
