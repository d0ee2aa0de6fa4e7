import math
import random
import time
from pathlib import Path

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import kernels, leaks, mixing, neardup, packing, pii, quality, tokens, truncation
from textloom.storage import materialize


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(1)
    base = [prose(rng, 60) for _ in range(20)]
    texts = base + [b.replace(" ", "  ").upper() for b in base[:5]] + [b + " " + prose(rng, 6) for b in base[5:12]] + ["", None, "abc", "abc"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, rid string")
    got = {tuple(r) for r in neardup.NearDuplicates(df, "id", "text").found().collect()}
    grams = [{s[i : i + 5] for i in range(len(s) - 4)} for s in ("".join((t or "").lower().split()) for t in texts)]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if grams[i] and grams[j] and len(grams[i] & grams[j]) >= 0.7 * len(grams[i] | grams[j])}
    assert got == want and len(want) >= 10
    groups = neardup.NearDuplicates(df, "id", "text").groups().collect()
    assert {r.row_id for r in groups} == {i for p in want for i in p}
    near: dict[int, int] = {i: i for i in range(len(texts))}
    for _ in range(len(texts)):
        for i, j in want:
            near[i] = near[j] = min(near[i], near[j])
    assert {r.row_id: r.group_id for r in groups} == {i: near[i] for p in want for i in p}
    assert neardup.NearDuplicates(df.limit(0), "id", "text").found().count() == 0
    assert neardup.NearDuplicates(df.limit(0), "id", "text").groups().count() == 0


def test_a_crowd_of_like_texts_is_one_group(spark):
    rng = random.Random(5)
    body = prose(rng, 80)
    texts = [body + " " + prose(rng, 4) for _ in range(60)] + [prose(rng, 80) for _ in range(5)]
    near = neardup.NearDuplicates(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text")
    assert {(r.row_id, r.group_id) for r in near.groups().collect()} == {(i, 0) for i in range(60)}


def gram_sets(texts):
    return [{s[i : i + 5] for i in range(len(s) - 4)} for s in ("".join(t.lower().split()) for t in texts)]


def test_texts_that_share_sentences_are_parted_before_their_texts_meet(spark, monkeypatch):
    rng = random.Random(9)
    pool = [prose(rng, 12) for _ in range(30)]
    texts = [" ".join(rng.sample(pool, 8)) for _ in range(150)]
    texts += [t + " " + prose(rng, 5) for t in texts[:20]]
    sets = gram_sets(texts)
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(texts)) for j in range(i + 1, len(texts))}
    want = {p for p, s in alike.items() if s >= 0.7}
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for name, value in (("LEAST_PAIRS", 1), ("BOUND_PAIRS", 0.1), ("EXACT_PAIRS", 0.1)):  # many parts
        monkeypatch.setattr(neardup, name, value)
    near = neardup.NearDuplicates(df, "id", "text")
    met = [tuple(r) for r in near.candidates().collect()]
    assert len(met) == len(set(met)) and min(alike[p] for p in met) > 0.5
    assert {tuple(r) for r in near.found().collect()} == want and len(want) >= 20


def test_near_duplicates_drop_shuffle_files_and_broadcast_no_entries(spark):
    rng = random.Random(10)
    texts = [prose(rng, 60) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts + [t + " x" for t in texts])), "id long, text string")
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {str(p): p.stat().st_size for d in dirs for p in Path(d).rglob("shuffle_*.data")}
    before = files()
    left = lambda: sum(n for p, n in files().items() if p not in before)
    near = neardup.NearDuplicates(df, "id", "text")
    assert near.links().count() == 40
    for _ in range(50):  # they are removed in the background
        if left() < 10_000:
            break
        time.sleep(0.2)
    assert left() < 10_000  # counts leave a few bytes a task
    assert "BroadcastExchange" not in near._met(0)._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=5, max_size=400), st.text("abcd", min_size=5, max_size=900), st.integers(0, 400))
def test_bitmaps_bound_what_texts_share(x, y, cut):
    texts = [x, x[:cut] + y, y]
    sets = gram_sets(texts)
    bits = [np.frombuffer(b, np.uint64)[None] for b in neardup.fingerprints(texts)["bits"]]
    for i in range(3):
        for j in range(3):
            n = [np.array([len(sets[k])]) for k in (i, j)]
            assert len(sets[i] & sets[j]) <= neardup.most_shared(bits[i], bits[j], *n)[0] <= min(n)[0]


def test_planes_tell_the_distance_of_segments(spark):
    rng = random.Random(11)
    base = prose(rng, 50)
    f = neardup.fingerprints([base, base + " " + prose(rng, 15), prose(rng, 50)])
    rows = spark.createDataFrame([(i, [*map(int, f["segs"][i])], *map(int, f["planes"][i])) for i in range(3)], "i int, segs array<long>, " + ", ".join(f"p{p} long" for p in range(neardup.PLANES + 1)))
    both = rows.alias("x").join(rows.alias("y"), F.col("x.i") < F.col("y.i"))
    got = both.select(neardup._plane_distance().alias("d"), F.col("x.segs").alias("segs_a"), F.col("y.segs").alias("segs_b")).select("d", neardup._distance().alias("e")).collect()
    assert all(r.d == r.e for r in got) and len({r.d for r in got}) > 1


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_trie_counts_equal_the_tokenizer(name):
    path = f"/opt/tokenizers/{name}"
    enc = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=tokens.load_ranks(path), special_tokens={})
    for text in ("don't  stop\n\n\n  now   ", "पंचायत ने 1234567 पद", "a\n \t b", " x", "", "résumé <|endoftext|>", "aaaaaaaaaaaaaaaaaaaa"):
        cut = tokens.chunks(text)
        assert "".join(cut) == text
        counts = tokens.count_chunks([c for c in cut if c], tokens.TriePath(tokens.load_ranks(path)))
        assert sum(sum(tokens.unpacked(n)) for n in counts) == len(enc.encode_ordinary(text))


def test_token_counts_table(spark):
    df = spark.createDataFrame([(1, "hello world", "a"), (2, None, "b"), (3, "", "c")], "id long, text string, tokens string")
    got = {r.id: r.tokens for r in tokens.token_counts(df, "id", "text").collect()}
    assert got[2] == got[3] == 0 and got[1] >= 2


def test_unusable_counts_are_judged_by_the_trie_counts(spark):
    rng = random.Random(8)
    vocab = "the a road market water people school under between village because important government".split()
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 90))) for _ in range(200)] + ["xq zvk wqjx " * 30] * 5 + ["", None]
    given = [len((t or "").split()) + 3 for t in texts[:200]] + [60] * 5 + [None, None]
    given[7], given[9], given[11] = given[7] * 5, given[9] // 5, -1
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, given, strict=True))], "id long, t string, g long")
    rows = df.join(tokens.token_counts(df, "id", "t"), "id")

    def off(rows):
        r = {x.id: x.g / x.expected for x in tokens.expected_counts(rows, "g").where("g > 0").collect()}
        return {i for i, v in r.items() if v >= 3 or v <= 1 / 3}

    assert off(rows) == {7, 9}
    assert off(rows.withColumn("kinds", F.transform("kinds", lambda k: k * 0))) != {7, 9}  # nothing but the counts decides
    assert tokens.fit_rates(rows.limit(0), "g") == [1.0] * len(tokens.CLASSES)


def test_personal_data():
    names = pii.Names([("Asha", "en", "given"), ("Verma", "en", "family")] * 2)
    texts = ["Mail a.b (at) x (dot) org, call +९१-९८७६५४३२१०.", "Asha Verma lives at 12 Temple Road, Velari 560 001.", "no. 1111 2222 3334", None, "", "icon@2x.png"]
    hits = pii.detect(texts, names)
    assert {(d, label) for d, _, _, label in hits} == {(0, "EMAIL"), (0, "PHONE"), (1, "NAME"), (1, "ADDRESS")}
    spans = [(a, b, label) for d, a, b, label in hits if d == 0]
    assert pii.redact(texts[0], spans) == "Mail [EMAIL], call [PHONE]."
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.verhoeff("2363") and not pii.verhoeff("2364")


SPELL = "zero one two three four five six seven eight nine".split()


@settings(max_examples=60, deadline=None)
@given(st.text("0123456789", min_size=9, max_size=9), st.sampled_from(["plain", "native", "full", "words"]), st.integers(1, 200), st.sampled_from(["@", " (at) ", " [at] ", "&#64;", "＠"]), st.sampled_from([".", " (dot) ", "&period;"]))
def test_nothing_of_a_disguised_value_is_left(tail, disguise, long, at, dot):
    number = "9" + tail
    told = {
        "plain": number, "native": "".join(chr(0x966 + int(c)) for c in number), "full": "".join(chr(0xFF10 + int(c)) for c in number),
        "words": " ".join(SPELL[int(c)] for c in number),
    }[disguise]
    mail = "ab." * long + "cd" + at + "sub" + dot + "x" * min(long, 60) + dot + "org"
    text = f"Please call {told} now. Mail {mail} today."
    hits = pii.detect([text], pii.Names([]))
    assert pii.redact(text, [h[1:] for h in hits]) == "Please call [PHONE] now. Mail [EMAIL] today."


def test_leaks(spark):
    item = "the quick brown fox jumps over one lazy dog while seven cats watch it from a wall"
    index = leaks.ItemIndex([5, 6], [item, "tiny words"], 13, 2)
    texts = ["x <b>The QUICK</b> brown fox, jumps over&nbsp;one lazy dog while seven cats watch", " ".join(item.split()[:12]), "Tiny, words!", "", None]
    got = {(d, int(index.ids[i])) for d, i, e in index.scan(texts) if e == 0}
    assert got == {(0, 5), (2, 6)}
    edited = {(d, i): e for d, i, e in index.scan([item.replace("lazy", "lazzy").replace("seven", "sevem")])}
    assert edited[(0, 0)] in (0, 1, 2)
    tiny = leaks.ItemIndex([1, 2, 3, 4], ["if a", "ok?", "is it so", "the old road by"], 13, 2)
    assert {(d, int(tiny.ids[i])) for d, i, e in tiny.scan(["IF-A b", "nok", "is IT, so!", "an old road", "the old road bi"]) if e == 0} == {(0, 1), (1, 2), (2, 3)}
    assert max(q for q, *_ in tiny.tables) == 5 and min(q for q, *_ in tiny.tables) > 1  # no table of single characters
    empty = spark.createDataFrame([], "id long, t string")
    assert leaks.find_leaks(empty, "id", "t", empty, "id", "t").count() == 0


def test_packing(spark):
    rng = random.Random(3)
    sizes = [(i, rng.choice(["web", None, "indic"]), rng.randint(1, 5000)) for i in range(600)] + [(900, "web", 0), (901, "web", None), (902, "web", 4096)]
    out = packing.pack_sequences(spark.createDataFrame(sizes, "doc_id long, lane string, n long").repartition(5), "lane", "doc_id", "n").toPandas()
    assert out.groupby("sequence_id").tokens.sum().max() <= 2048
    assert out.groupby("doc_id").tokens.sum().to_dict() == {i: n for i, _, n in sizes if n}
    assert set(out[out.doc_id.isin([i for i, _, n in sizes if n and n < 2048])].groupby("doc_id").size()) == {1}
    assert (out.groupby("sequence_id").lane.nunique() == 1).all()
    pack = packing.OnlineBestFit(10, 2)
    pack.put("a", 4), pack.put("b", 7)
    assert pack.fit(5) == ("b", 7) and pack.fit(5) is None


def test_cut_texts(spark):
    whole = [(i, f"The board met in town {i}. It was calm and the road is open to all of us.", "web") for i in range(60)]
    odd = [(100, "The board met in town 5. It was calm and the road is", "web"), (101, "Page one: roads", "web"), (102, "", "web"), (103, None, "web")]
    got = {r.id: r.cut for r in truncation.cut_texts(spark.createDataFrame(whole + odd, "id long, t string, lane string"), "id", "t", "lane").collect()}
    assert got[100] and not any(got.get(i) for i in (*range(60), 101, 102)) and 103 not in got


def test_cut_words_do_not_vouch_for_each_other(spark):
    whole = [(i, f"The board met in town {i}. Now the roads of towns are open to all of us{' and so on' * (i % 7)}.", "web") for i in range(300)]
    cut = [(1000 + i, f"The council of ward{'abcdef'[i]} sat. Now the roads of t", "web") for i in range(6)]
    signed = [(2000 + i, f"The council of ward{'abcdef'[i]} sat late.\n-30-", "web") for i in range(6)] + [(3000 + i, f"The board met late.\nTown {'abcdef'[i]}", "web") for i in range(6)]
    got = {r.id: r.cut for r in truncation.cut_texts(spark.createDataFrame(whole + cut + signed, "id long, t string, lane string"), "id", "t", "lane").collect()}
    assert all(got[1000 + i] for i in range(6)) and not any(got[i] for i in (*range(300), *range(2000, 2006)))


def test_prose_cut_in_its_only_sentence(spark):
    whole = [(i, f"The board met in town {i}. Now the board of the town opened the road to all of us.", "web") for i in range(100)]
    odd = [(200, "Now the board of the town opened the", "web"), (201, "The Road to the Town", "web"), (202, "the board 5 kg, the town, the road / opened the, of the\n| the board | of | the |", "web")]
    got = {r.id: r.cut for r in truncation.cut_texts(spark.createDataFrame(whole + odd, "id long, t string, lane string"), "id", "t", "lane").collect()}
    assert got[200] and not got[201] and not got[202] and not any(got[i] for i in range(100))


def test_cut_texts_are_looked_for_in_compiled_code(spark, monkeypatch):
    plans = {}

    def written(df, name, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, name, *rest)

    monkeypatch.setattr(truncation, "materialize", written)
    rows = [(i, f"The board met in town {i}. It was calm\tand 5 < 7; the road is open.", ("web", "code")[i % 2]) for i in range(20)]
    assert truncation.cut_texts(spark.createDataFrame(rows, "id long, t string, lane string"), "id", "t", "lane").count() == 20
    assert {"p8-lines", "p8-last", "p8-counts"} <= set(plans)
    assert not [name for name in ("p8-lines", "p8-last", "p8-counts") if "lambda" in plans[name]]  # functions over arrays are interpreted, word by word


def test_kinds_of_words(spark):
    signs = [*truncation.LAST_SIGNS, "a", "Z", "क", "५", "", "|"]
    words = [w + c for w in ("", "Word", "word", "कख") for c in signs]
    got = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", f"{truncation._kind('w', 'right(w, 1)')} AS k").collect()
    assert {r.w: r.k for r in got} == {w: truncation.LAST_SIGNS.get(w[-1:], "W" if "A" <= w[:1] <= "Z" else "w") for w in words}


def test_near_duplicate_limits_lose_few_pairs():
    for trials, p in ((neardup.SKETCH, 0.75 * 0.3), (neardup.SEGMENTS * neardup.SYMBOLS, 0.3)):
        lost = 1 - sum(math.comb(trials, i) * p**i * (1 - p) ** (trials - i) for i in range(neardup._slack(trials, p) + 1))
        assert lost < 2e-4


def test_boosted_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = (x[:, 0] > 0).astype(int) + 2 * (x[:, 1] > 0.5)
    model = quality.Boosted(rounds=15).fit(x[:1500], y[:1500], np.ones(1500))
    scores = model.scores(x[1500:])
    assert (scores.argmax(1) == y[1500:]).mean() > 0.95
    assert 0.2 <= quality.calibrate(scores, y[1500:])[0] <= 3
    assert quality.statistics(None, frozenset()) == [0.0] * len(quality.NAMES)


def test_mixing(spark):
    shards = [(f"s{i}", lane, 1000 + 37 * i, i) for i in range(200) for lane in ["Web" if i % 4 else " CODE"]] + [("s1", None, None, 999), ("n", None, 5, 1)]
    registry = spark.createDataFrame(shards, "shard_id string, capability_lane string, token_count long, registered_at long")
    targets = spark.createDataFrame([(1, "Web", 0.6, 1), (1, "Code", 0.4, 3)], "plan_id int, lane string, target_share double, max_repeats int")
    seen = spark.createDataFrame([("r", "b", 1, "c", 0, "m", "web_lane")], "run_id string, branch_id string, global_step long, checkpoint_id string, worker_rank int, microbatch_id string, mixture_lane string")
    got = {r.lane: r for r in mixing.mixture_report(registry, targets, seen).collect()}
    assert all(abs(r.reached_share - r.target_share) < 0.01 and r.most_uses <= r.max_repeats for r in got.values())
    assert abs(got["web"].lane_alpha - 1) > 0.01 and got["web"].reached_bits == pytest.approx(got["web"].target_bits, abs=0.01)
    twice = spark.createDataFrame([(1, "Web", 0.25, 1), (1, "web_lane", 0.25, 2), (1, "code", 0.5, 9)], "plan_id int, lane string, target_share double, max_repeats int")
    both = {r.lane: (r.target_share, r.max_repeats) for r in mixing.mixture_report(registry, twice, seen).collect()}
    assert both == {"web": (0.5, 2), "code": (0.5, 9)}
    flat = mixing.mixture_report(registry, targets, seen, bits=0.9).collect()
    assert all(r.reached_bits == pytest.approx(0.9, abs=0.01) and r.plan_alpha == r.lane_alpha for r in flat)
    alike = spark.createDataFrame([(f"e{i}", "Web", 500, 1) for i in range(300)] + [(f"c{i}", "Code", 300, 1) for i in range(300)], registry.schema)
    mixing.BLOCK_ROWS, kept = 50, mixing.BLOCK_ROWS
    even = {r.lane: r for r in mixing.mixture_report(alike, targets, seen).collect()}
    mixing.BLOCK_ROWS = kept
    assert abs(even["web"].reached_share - 0.6) < 0.01
    assert mixing.mixture_uses(registry.limit(0), targets).agg(F.sum("uses")).first()[0] is None


def test_temperature():
    p, t = [0.7, 0.2, 0.1], [0.5, 0.25, 0.25]
    plan, own = mixing.lane_exponents(p, t)
    assert mixing.entropy(mixing.tempered(p, plan)) == pytest.approx(1.5, abs=1e-6)
    w = [x**a for x, a in zip(p, own, strict=True)]
    assert [x / sum(w) for x in w] == pytest.approx(t, abs=1e-9)
    assert mixing.lane_exponents([1.0], [1.0])[1] == [mixing.lane_exponents([1.0], [1.0])[0]]


def test_kernels():
    grams, owner = kernels.gram_hashes(kernels.codes_of(kernels.join_texts(["abcdef", None, "abcde"])), 5)
    assert owner.tolist() == [0, 0, 2] and grams[0] == grams[2]
