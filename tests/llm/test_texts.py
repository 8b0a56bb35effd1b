import random
import re
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import fundloom.llm.encoding as enc
from fundloom.llm.leakage import cleaned, leaked_spans, leaks
from fundloom.llm.toxicity import fit, passages, probabilities, rates, scores

sys.path.insert(0, "tests")
from conftest import rows  # noqa: E402


@pytest.fixture(scope="module")
def encode():
    return enc.encoder(enc.TOKENIZERS)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t ab1'é中\U0001f600.s"), max_size=300))
def test_chunks_agree_with_the_whole(text):
    whole = enc.encoder.cached if hasattr(enc.encoder, "cached") else enc.encoder(enc.TOKENIZERS)
    enc.encoder.cached = whole
    mean, longest = enc.MEAN_CHUNK, enc.LONGEST_CHUNK
    enc.MEAN_CHUNK, enc.LONGEST_CHUNK = 4, 30
    try:
        assert enc.ChunkEncoder(whole, store_chars=200)(text) == whole(text)
    finally:
        enc.MEAN_CHUNK, enc.LONGEST_CHUNK = mean, longest


def test_ids(spark, encode):
    long = "word " * 30_000 + "x" * 20_000 + "  end <|endoftext|>"
    data = [(1, "Hello  world's end", "c"), (2, "", "c"), (3, None, "c"), (4, long, "c"), (None, " ", "c"), (1, "Hello  world's end", "c")]
    got = enc.token_ids(spark.createDataFrame(data, "doc_id long, text string, ids string")).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.ids) for r in got) == sorted((i is None, i, encode(t) if t else []) for i, t, _ in data)
    assert enc.token_ids(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chunks_are_reused(encode):
    rnd = random.Random(0)
    page = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) + str(rnd.randrange(99)) for _ in range(300)) for _ in range(3)]
    e = enc.ChunkEncoder(encode)
    texts = [f"intro {i} " + page[i % 3] for i in range(30)]
    assert [e(t) for t in texts] == [encode(t) for t in texts] and e.reused > 3 * e.encoded


def brute_leaks(docs, items):
    word = lambda s: re.findall(r"[^\W_]+", (s or "").lower())
    out = set()
    for d, t in docs:
        w = word(t)
        for i, x in items:
            v = word(x)
            n = min(12, len(v))
            runs = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            if any(tuple(w[k : k + n]) in runs for k in range(len(w) - n + 1)):
                out.add((d, i))
    return sorted(out)


def test_leaks_against_brute_force(spark):
    rnd = random.Random(1)
    some = lambda n: " ".join(rnd.choice("abcdefgh") for _ in range(n))
    items = [(i, some(rnd.choice([1, 3, 8, 11, 12, 13, 40]))) for i in range(25)] + [(90, ""), (91, None), (92, "a, B!")]
    docs = [(i, some(rnd.randrange(60)) + " " + (items[rnd.randrange(25)][1].upper().replace(" ", "; ") if i % 3 else "")) for i in range(80)] + [(900, None), (901, ""), (902, "x")]
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(leaks(d, t)) == brute_leaks(docs, items)
    assert rows(leaks(d.limit(0), t)) == [] and rows(leaks(d, t.limit(0))) == []
    assert rows(leaked_spans(d, t, 12).select("doc_id", "item_id").distinct()) == brute_leaks(docs, items)


def test_cleaned(spark):
    """What stays is the text as it was written: case, punctuation and line breaks."""
    item = " ".join(f"t{i}" for i in range(14))
    docs = [
        (1, f"Before,\n\n{item.upper()}. After!  "), (2, "clean"), (3, f"{item} -- {item} İstanbul, ok?"), (4, item), (5, None), (6, ""), (None, item), (7, f"İ {item} (Not) this: short one, a short one"), (7, "twice"),
        (8, " ".join(f"t{i}" for i in range(1, 14)) + " t0 t1"),
    ]
    items = [(5, item), (6, "A short one"), (7, ""), (8, None)]
    got = rows(cleaned(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    want = {1: (16, 14, "Before. After!  "), 3: (30, 28, " İstanbul, ok?"), 4: (14, 14, ""), 7: (22, 17, "İ (Not) this: short one"), 8: (15, 13, " t0 t1")}
    assert {r[0]: r[1:] for r in got if r[3] != "twice" and r[3]} | {4: (14, 14, "")} == want
    assert rows(cleaned(spark.createDataFrame(docs[1:2], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))) == []


def test_large_test_sets_go_in_parts(spark):
    from fundloom.llm import leakage

    rnd = random.Random(2)
    some = lambda n: " ".join(rnd.choice("abcdefgh") for _ in range(n))
    items = [(i, some(rnd.choice([3, 12, 30]))) for i in range(40)]
    docs = [(i, some(20) + " " + rnd.choice(items)[1]) for i in range(40)]
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, leakage.BROADCAST_WORDS = leakage.BROADCAST_WORDS, 100
    try:
        assert rows(leaks(d, t)) == brute_leaks(docs, items)
    finally:
        leakage.BROADCAST_WORDS = whole



ABUSE = ["you {x} idiot go to hell", "shut up you filthy {x} pig", "these {x} people are scum and vermin"]
CALM = ["the study measures {x} lakes near the coast", "we compare {x} soils over three winters", "a training course on {x} is offered", "the word idiot was rated by {x} readers"]


def corpus(seed, n):
    rnd = random.Random(seed)
    x = lambda: rnd.choice(["red", "old", "small", "green", "late", "wild"])
    out = []
    for i in range(n):
        bad = i % 6 == 0
        s = [rnd.choice(CALM).format(x=x()) for _ in range(6)]
        if bad:
            t = rnd.choice(ABUSE).format(x=x())
            s.insert(rnd.randrange(6), t.replace("i", "1") if i % 12 == 0 else t)
        out.append((i, ". ".join(s) + ".", bad))
    return out


SCRIPTS = {
    "Greek": ("είσαι ένας ηλίθιος {x} βλάκας", "η μελέτη μετρά {x} λίμνες στην ακτή"), "Hebrew": ("אתה {x} אידיוט מטומטם", "המחקר מודד {x} אגמים ליד החוף"), "Hindi": ("तुम एक {x} बेवकूफ गधे हो", "यह अध्ययन {x} झीलों को मापता है"),
    "Thai": ("แกมันไอ้โง่ {x} เลวทราม", "การศึกษานี้วัด {x} ทะเลสาบ"), "Korean": ("너는 {x} 멍청한 바보야", "이 연구는 {x} 호수를 측정한다"),
}


def test_every_script_is_read():
    """Letters of every script stay, and abuse in one that has ratings is learnt."""
    assert [len(passages(a)) for a, _ in SCRIPTS.values()] == [1] * 5
    rnd = random.Random(4)
    for bad, calm in SCRIPTS.values():
        make = lambda b: ". ".join(rnd.sample([(bad if b and i == 0 else calm).format(x=rnd.choice("12345")) + " " + "".join(rnd.choice("abcde") for _ in range(5)) for i in range(4)], 4))  # noqa: B023, E731
        data = [(make(i % 5 == 0), i % 5 == 0) for i in range(150)]
        model = fit([passages(t) for t, _ in data[:100]], np.array([float(b) for _, b in data[:100]]))
        assert np.mean([(probabilities(passages(t), model.logit).max() >= model.mark) == b for t, b in data[100:]]) > 0.9


def test_held_out_accuracy():
    rnd = random.Random(9)
    train, test = corpus(1, 400), corpus(2, 300)
    rating = np.array([float(b if rnd.random() > 0.03 else not b) for _, _, b in train])  # raters err
    logit, mark = fit([passages(t) for _, t, _ in train], rating)
    hit = [probabilities(passages(t), logit).max() >= mark for _, t, _ in test]
    tp, fp, fn = (sum(h and b for h, (_, _, b) in zip(hit, test, strict=True)), sum(h and not b for h, (_, _, b) in zip(hit, test, strict=True)), sum(b and not h for h, (_, _, b) in zip(hit, test, strict=True)))
    assert 2 * tp / (2 * tp + fp + fn) > 0.95


def test_scores(spark):
    docs = [(i, t, "a" if i % 2 else None, "clash") for i, t, _ in corpus(3, 60)] + [(900, None, "a", ""), (901, "", "a", ""), (902, " \n", "b", ""), (903, "you old idiot go to hell. " * 3000, "b", ""), (None, "x", "b", "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, score string")
    r = spark.createDataFrame([(i, "r1", int(b)) for i, _, b in corpus(3, 60)] + [(None, "r1", 1), (5, "r2", None), (9999, "r1", 1)], "doc_id long, rater string, flagged long")
    got = {x.doc_id: x.score for x in scores(d, r).collect()}
    assert got[900] == got[901] == got[902] == 0 and len(got) == 65
    assert {x.source for x in rates(scores(d, r)).collect()} == {None, "a", "b"}
    assert scores(d, r.limit(0)).count() == 65 and scores(d.limit(0), r).count() == 0
