"""Runs of words, conversations and languages."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakemart.llm import byte_convnet, conversation_repair, periodic_runs
from lakemart.llm.conversation_repair import ASSISTANT, BLANK, CUT, DUPLICATE, START, SYSTEM, USER

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(words, least):
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q) and not any(all(words[k] == words[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    draw = random.Random(5)
    for _ in range(1500):
        words = [draw.choice("abc"[: draw.randint(1, 3)]) for _ in range(draw.randint(0, 50))]
        if words and draw.random() < 0.5:
            a, p = draw.randrange(len(words)), draw.randint(1, 9)
            words = [words[a + (i - a) % p] if i >= a + p else w for i, w in enumerate(words)]
        least = draw.choice([2, 3, 5, 12])
        got = [(s, n, q) for s, q, n in periodic_runs.runs_of_words([w.encode() for w in words], least).tolist()]
        assert got == brute_runs(words, least)


@pytest.mark.parametrize("words", [["a"] * 5000, ["a", "b", "c", "a", "b"] * 900, [f"w{i % 1000}" for i in range(4000)]])
def test_long_periodic_texts(words):
    found = periodic_runs.runs_of_words([w.encode() for w in words], 12)
    assert found[:, 0].min() == 0 and found[:, 2].max() == len(words)


def test_runs_of_rows(spark, odd, empty):
    again = "x y z. " * 9 + "und so weiter " + "ä " * 20
    docs = odd.union(spark.createDataFrame([(70, again, "en", "s", 1, "own", 1)] * 2, odd.schema))
    docs = docs.withColumnsRenamed({"lang": "runs", "source": "collapsed"})
    found = periodic_runs.find_runs(docs).collect()
    assert len(found) == 12 and set(docs.columns) < set(periodic_runs.find_runs(docs).columns)
    for r in found:
        words = WORD.findall(r["text"] or "")
        runs = brute_runs(words, 12) if len(words) < 1000 else [(0, len(words), 7)]
        assert [tuple(x) for x in r["runs_"]] == runs and r["n_words"] == len(words)
        assert bytes(r["collapsed_"]).decode() == brute_collapsed(words, runs)
    assert periodic_runs.find_runs(empty).count() == 0
    assert periodic_runs.digests(periodic_runs.planted(empty)).count() == 0
    assert periodic_runs.digests(periodic_runs.planted(odd)).count() == odd.count()


def test_runs_of_documents(spark, small, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = contract.queries()["op11_periodic_runs"](spark, small).collect()
    assert {r["doc_id"] for r in got} == set(texts) and sum(r["n_runs"] > 0 for r in got) > 10
    for r in got:
        words = WORD.findall(texts[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        elif n > 1500:
            continue
        runs = brute_runs(words, 12)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()


def brute_repair(rows):
    """Least cost and least letters over ``(initial, fault)`` rows, from the end backwards over whole strings."""
    after = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

    @lru_cache(None)
    def rest(i, state, inserted):
        ways = [(0, "")] if i == len(rows) and state in (START, ASSISTANT) else []

        def add(price, letter, *place):
            cost, letters = rest(*place)
            ways.append((price + cost, letter + letters))

        if inserted < 4:
            add(2, "I", i, after[state], inserted + 1)
        if i < len(rows):
            initial, fault = rows[i]
            add(3, "D", i + 1, state, 0)
            if fault not in (BLANK, DUPLICATE):
                add(2 + (fault == CUT), "R", i + 1, after[state], 0)
                kept = {"u": USER if state != USER else None, "a": ASSISTANT if state == USER else None, "s": SYSTEM if state == START else None}.get(initial)
                if kept is not None:
                    add(fault == CUT, "K", i + 1, kept, 0)
        return min(ways, default=(10**9, ""))

    return rest(0, START, 0)


def test_decoder_finds_the_least_of_the_cheapest():
    draw = random.Random(8)
    for _ in range(4000):
        rows = tuple((draw.choice("uauast"), draw.choice([0, 0, 0, BLANK, DUPLICATE, CUT])) for _ in range(draw.randint(0, 11)))
        decoder, got = conversation_repair.Decoder(), []
        for row in rows:
            got += decoder.push(*row, (row[0], b""))
        got += decoder.finish()
        assert (decoder.cost, "".join(x[0] for x in got)) == brute_repair(rows)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for letter, role, _ in got if letter != "D"))
        assert decoder.unresolved == 0


def test_decoder_holds_what_is_unresolved():
    decoder, most = conversation_repair.Decoder(), 0
    for k in range(6000):
        list(decoder.push("uasu"[k % 4], k % 7 % 4, ("x", b"")))
        most = max(most, decoder.unresolved)
    assert most < 100


def python_summary(rows):
    """All columns of a conversation from its rows ``(turn, role, text)``, after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append(BLANK if not WORD.search(text) else DUPLICATE if (role, text) in seen else CUT if text.rstrip(" \t\n\v\f\r")[-1] not in ".!?" else 0)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, letters = brute_repair(tuple((r[:1], f) for (_, r, _), f in zip(rows, faults)))
    out, at, last = [], 0, None
    for letter in letters:
        role = "assistant" if last == "u" else "user"
        text = ""
        if letter != "I":
            _, own, text = rows[at]
            role = own if letter == "K" else role
            at += 1
        if letter != "D":
            out.append(f"{role}:{text}")
            last = role[0]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, letters, digest


def python_damage(rows):
    blank = lambda x: " " if x is None else str(x)
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        made = out.setdefault(conv, [])
        row = (turn, "user" if kind == 4 else blank(role), "" if kind == 1 else re.sub("[.!?]", "", blank(text)) if kind == 2 else blank(text))
        made += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: python_summary(r) for c, r in out.items()}


def summary_rows(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_repair_of_conversations(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    got = contract.queries()["op12_conversation_repair"](spark, small)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = python_damage([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert summary_rows(got) == want and {"K", "D", "R", "I"} <= set("".join(w[6] for w in want.values()))


ODD_ROWS = [
    (1, None, "system", "Be short."), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 2, "assistant", "Yes "), (1, 9, "assistant", "Yes "), (2, 3, None, None),
    (2, None, "user", None), (None, 1, "user", "a."), (None, 1, "tool", "b!"), (3, 1, "", "é?"), (3, 2, "User", "x. \t"), (3, 5, "user", "x. \t"),
] + [(4, i, "tool", f"t{i}.") for i in range(41)] + [(5, i, "user" if i % 2 else "assistant", "Same.") for i in range(30)] + [(6, 1, "user", "long. " * 20000)]


def test_repair_of_odd_rows(spark):
    odd = spark.createDataFrame([(*r, 1, "x") for r in ODD_ROWS], "conv_id bigint, turn bigint, role string, text string, _conv int, _seen string")
    assert summary_rows(conversation_repair.repair_damaged(odd)) == python_damage(ODD_ROWS)
    own = {c: python_summary([(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in ODD_ROWS if k == c]) for c, *_ in ODD_ROWS}
    assert summary_rows(conversation_repair.summaries(odd)) == own
    edits = conversation_repair.repaired(odd).orderBy("conv_id", "place").collect()
    for conv, want in own.items():
        mine = [r for r in edits if r["conv_id"] == conv]
        assert "".join(r["edit"] for r in mine) == want[6] and [r["place"] for r in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in mine if r["edit"] != "D").encode()).hexdigest() == want[7]
    nothing = odd.limit(0)
    assert conversation_repair.repair_damaged(nothing).count() == conversation_repair.repaired(nothing).count() == 0
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    lost = conversation_repair.repair_damaged(spark.createDataFrame([(dropped, 0, "user", "a.")], "conv_id int, turn int, role string, text string"))
    assert tuple(lost.first()) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_gradients():
    draw = np.random.default_rng(0)
    size, filters = byte_convnet.SIZE, byte_convnet.FILTERS
    values = {"bytes": draw.normal(0, 0.3, (256, size)), "out": draw.normal(0, 0.1, (filters * len(byte_convnet.WIDTHS), 3)), "offset": np.zeros(3)}
    for w in byte_convnet.WIDTHS:
        values |= {f"filters{w}": draw.normal(0, 0.3, (w * size, filters)), f"bias{w}": draw.normal(0, 0.1, filters)}
    windows, labels = draw.integers(0, 256, (4, byte_convnet.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        found = byte_convnet.Model(values, ["a", "b", "c"]).probabilities(windows)
        return -np.log(found[np.arange(4), labels]).mean()

    slopes = byte_convnet._gradients(values, windows, labels)
    for name, value in values.items():
        for _ in range(4):
            at = (int(windows[draw.integers(4), draw.integers(byte_convnet.WINDOW)]), 0) if name == "bytes" else tuple(draw.integers(n) for n in value.shape)
            old = value[at]
            value[at] = old + 1e-6
            up = loss()
            value[at] = old - 1e-6
            down = loss()
            value[at] = old
            assert abs((up - down) / 2e-6 - slopes[name][at]) < 1e-4


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = contract.queries()["op13_byte_convnet"](spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97


def test_languages_of_odd_rows(spark, odd, empty):
    found = byte_convnet.languages(odd).collect()
    assert len(found) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in (1, 2, 3)) and texts[2] is None
    assert all(r["lang_pred"] in ("en", "de") and r["score"] > 0 for r in found if r["doc_id"] in (4, 5, 6, 7))
    assert byte_convnet.languages(empty).count() == 0
    unlabelled = byte_convnet.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"} and len(unlabelled) == odd.count()
    clash = odd.withColumnsRenamed({"lang": "lang_pred", "source": "score"})
    assert byte_convnet.predictions(clash, byte_convnet.Model({}, [])).columns[-2:] == ["lang_pred_", "score_"]


def test_windows_together_are_windows_alone():
    texts = [b"ab " * 40000, b"", b"xy", "é".encode() * 300, b"123"]
    model = byte_convnet.train([w for t in (b"ab " * 500, b"xy " * 500) for w in byte_convnet.spread(t, 4)], ["a"] * 4 + ["x"] * 4, steps=20)
    whole = byte_convnet.score(model, texts)
    assert [x for x, _ in whole] == [x for t in texts for x, _ in byte_convnet.score(model, [t])]
    assert np.allclose([x for _, x in whole], [x for t in texts for _, x in byte_convnet.score(model, [t])], atol=1e-5)
    assert whole[1] == whole[4] == ("und", 0.0) and whole[0][0] == "a" and whole[2][0] == "x"
