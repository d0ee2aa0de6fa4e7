import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom import storage
from textloom.operators import audits, corpus, minhash, packing, sequences
from textloom.operators.components import connected_components, linked_groups
from textloom.plans import catalog
from textloom.sources import tables
from textloom.streaming import ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (7, 7), (None, 3)]
    got = dict(rows(connected_components(spark.createDataFrame(chain, "a long, b long"))))
    assert {got[i] for i in range(21)} == {0} and {got[i] for i in (40, 45, 50)} == {40} and len(got) == 24
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


def test_groups_lose_no_link_of_a_bucket(spark):
    rng = random.Random(2)
    buckets = [(b, rng.randrange(40)) for b in range(12) for _ in range(9)]
    links = {tuple(sorted((rng.randrange(40), rng.randrange(40)))) for _ in range(60)}
    known = spark.createDataFrame(sorted(p for p in links if p[0] < p[1]), "a long, b long")
    got = dict(rows(linked_groups(spark.createDataFrame(buckets, "bucket long, node long"), lambda pairs: pairs.join(known, ["a", "b"], "left_semi"))))
    met = {tuple(sorted((x, y))) for b, x in buckets for c, y in buckets if b == c and x != y}
    own = {i: i for i in range(40)}
    for _ in range(40):
        for x, y in met & links:
            own[x] = own[y] = min(own[x], own[y])
    assert got == {i: own[i] for p in met & links for i in p}
    assert linked_groups(spark.createDataFrame([], "bucket long, node long"), lambda p: p).count() == 0


def test_boilerplate(spark):
    lines = spark.createDataFrame([(i, "the same long line\n the same long line\nshort", "x") for i in range(3)] + [(7, None, "y"), (8, "", "z")], "id long, text string, line string")
    assert rows(corpus.boilerplate_lines(lines, "id", "text")) == [("the same long line", 3)]
    assert dict(rows(corpus.boilerplate_share(lines, "id", "text"))) == {0: 2 / 3, 1: 2 / 3, 2: 2 / 3, 7: 0, 8: 0}


def test_routing_weighs_all_scripts(spark):
    odd = "ગગગક"  # a word with more Gujarati than Devanagari signs is no Hindi word
    df = spark.createDataFrame([(1, "a b c d ।।", 5), (2, "a b c d e", 6), (3, None, 7), (4, " ".join([odd] * 9), 8), (5, "कग कख कघ खग गक", 9), (6, "", 1)], "id long, text string, folder int")
    got = {r[0]: (r[1], r[2]) for r in corpus.route_by_script(df.drop("folder"), "id", "text").collect()}
    assert got == {1: (None, 0.8), 2: ("english", 1.0), 3: (None, 0.0), 4: (None, 0.0), 5: ("hindi", 1.0), 6: (None, 0.0)}
    n, per = corpus.word_scripts(["अগ গअ", None])
    assert n.tolist() == [2, 0] and per[0].tolist()[:2] == [1, 1]  # ties go to what comes first
    assert [r[0] for r in df.select(corpus.language_code(F.lit(" Telugu")), F.lit(0)).limit(1).collect()] == ["te"]


def test_exact_copies_keep_null_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "a"), (5, "")], "id long, text string")
    assert rows(corpus.exact_copies(df, "id", "text")) == [(1, 1, 2), (2, 2, 2), (3, 2, 2), (4, 1, 2), (5, 5, 1)]


def test_quantiles_are_exact(spark):
    rng = random.Random(4)
    values = [(g, v) for g, n in (("a", 501), ("b", 1), (None, 40)) for v in [rng.choice([1.0, 2.5, rng.gauss(0, 9)]) for _ in range(n)]] + [("a", None), ("c", None), ("b", float("nan"))]
    df = spark.createDataFrame(values, "g string, v double")
    got = {r["_g"]: r["q"] for r in corpus.exact_quantiles(df, "g", "v", [0.02, 0.5, 0.98], bins=8).collect()}
    for g in ("a", "b", None):
        own = [v for h, v in values if h == g and v is not None and v == v]
        assert got[g] == pytest.approx(list(np.quantile(own, [0.02, 0.5, 0.98])))
    assert got["c"] is None
    band = corpus.quantile_band(df.withColumn("k", F.monotonically_increasing_id()), "k", "g", "v")
    assert band.count() == len(values) and band.where("v IS NULL AND keep").count() == 0


def test_minhash(spark):
    assert minhash.best_bands(128, 0.8) == (8, 16)
    text = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, text, "a"), (2, text + " end", "a"), (3, "other words here", "a"), (4, "", "b"), (5, None, "b"), (6, text, "b")], "id long, text string, keep string")
    kept = {r.id: (r.cluster, r.keep) for r in minhash.survivors(df, "id", "text").collect()}
    assert kept == {1: (1, False), 2: (1, True), 3: (3, True), 4: (4, True), 5: (5, True), 6: (1, False)}
    apart = {r.id: r.cluster for r in minhash.survivors(df, "id", "text", track="keep").collect()}
    assert apart == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}
    same = {r.id: r.cluster for r in minhash.survivors(df, "id", "text", parity=True).collect()}
    assert same == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 1}
    assert minhash.survivors(df.limit(0), "id", "text").count() == 0


def test_signatures_follow_their_definition(spark):
    def plain(t):
        t = " ".join(t.split())
        runs = {t} if len(t) < 5 else {t[i : i + 5] for i in range(len(t) - 4)}
        out = set()
        for r in runs:
            h = 0
            for c in r:
                h = (h * minhash.BASE + ord(c)) % minhash.PRIME
            out.add(h)
        return out

    for t in ("ab", "hello  world\nagain 𝒳", "aaaaaaaa", "ஆ" * 9):
        assert set(minhash.shingles(t).tolist()) == plain(t)
    pairs = minhash.coefficients(16)
    a, b = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
    got = minhash.signature(minhash.shingles("the quick brown fox"), a, b)
    assert got.tolist() == [min((x * h + y) % minhash.PRIME for h in plain("the quick brown fox")) for x, y in pairs]
    assert len(minhash.shingles(" ")) == len(minhash.shingles(None)) == 0
    assert len(minhash.shingles("a b c d e f", unit="word")) == 2


def test_minhash_meets_pairs_at_the_threshold(spark):
    texts = []
    for i in range(30):
        w = [f"w{i}x{j}" for j in range(200)]
        texts += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:50] + ["new"] + w[51:100] + ["new"] + w[101:150] + ["new"] + w[151:]))]
    texts += [(100 + i, " ".join(f"v{j}" if j % 20 else f"v{j}y{i}" for j in range(200))) for i in range(2)]  # 0.6
    df = spark.createDataFrame(texts, "id long, text string")
    got = {r.id: r.cluster for r in minhash.survivors(df, "id", "text", unit="word").collect()}
    assert all(got[2 * i + 1] == 2 * i for i in range(30)) and got[100] == 100 and got[101] == 101


def test_rule_drops_count_every_rule(spark, tmp_path):
    fine = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} runs" if i % 2 else f"so{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    bad = {"term": "the cat " * 20, "lines": "a line of seven different words here\n" * 8, "paragraphs": (fine + "\n\n") * 2}
    texts = [(i, "web", f"{fine} number{chr(97 + i)}", "en", "web") for i in range(20)] + [(50 + i, "web", t, "en", "web") for i, t in enumerate(bad.values())] + [(90, "web", fine + " talk", "en", "speech")]
    spark.createDataFrame(texts, "doc_id long, lane string, text string, lang string, doc_type string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.queries()["q16_p4_p5_p7_rule_drops"](spark, str(tmp_path)).first().asDict()
    assert len(got) == 15 and got["total"] == 24 and got["drop_source_type"] == 1 and got["drop_term"] >= 1 and got["drop_lines"] >= 1 and got["drop_paragraphs"] == 1 and got["kept"] <= 20
    assert "ease" in catalog.queries()["q15_w1_quantile_band"](spark, str(tmp_path)).columns


def test_metrics_of_one_text_need_no_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("q4_top_2gram", "q5_term_frequency", "q6_lexical_diversity", "q11_duplicate_lines", "q12_duplicate_paragraphs"):
        assert "Exchange" not in catalog.queries()[name](spark, str(tmp_path))._jdf.queryExecution().toString()


def _packed(sizes, capacity):
    rooms, where = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = [(r, b) for b, r in enumerate(rooms) if r >= sizes[i]]
        b = min(fit)[1] if fit else len(rooms)
        if not fit:
            rooms.append(capacity)
        rooms[b] -= sizes[i]
        where[i] = b
    return where


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_plan_equals_item_by_item(sizes):
    plan, seen, got = packing.best_fit_plan(Counter(sizes), 30), Counter(), {}
    for i, n in enumerate(sizes):
        for size, a, b, sequence, each in plan:
            if size == n and a <= seen[n] <= b:
                got[i] = sequence + (seen[n] - a) // each
        seen[n] += 1
    assert got == _packed(sizes, 30)


def test_best_fit_decreasing_table(spark):
    rng = random.Random(6)
    items = [(i, rng.choice(["web", "indic"]), rng.choice([5, 7, rng.randint(1, 50)]), "x") for i in range(300)] + [(900, "web", None, "x"), (901, "web", 0, "x")]
    got = {r.id: (r.lane, r.sequence) for r in packing.best_fit_decreasing(spark.createDataFrame(items, "id long, lane string, n int, size string"), "lane", ["id"], "n", 50).collect()}
    for lane in ("web", "indic"):
        own = [(i, n) for i, x, n, _ in items if x == lane and n]
        want = _packed([n for _, n in own], 50)
        assert {i: got[i][1] for i, _ in own} == {own[k][0]: b for k, b in want.items()}
    assert packing.best_fit_decreasing(spark.createDataFrame([], "id long, lane string, n int"), "lane", ["id"], "n").count() == 0
    with pytest.raises(ValueError, match="fit"):
        packing.best_fit_plan({51: 1}, 50)


def test_shards_are_a_permutation(spark, tmp_path):
    df = spark.createDataFrame([(i, "web" if i % 3 else "code") for i in range(70)], "id long, lane string")
    got = packing.shuffled_shards(df, "lane", "id", 20).collect()
    assert len({(r.lane, r.shard_no, r.row_no) for r in got}) == 70 and max(r.row_no for r in got) == 19
    places = {r.doc_id: r.place for r in catalog.queries()["x2_shuffle"](spark, "/root/testdata/sf0.001").collect()}
    assert sorted(places.values()) == list(range(len(places)))


def test_sequences(spark):
    df = spark.createDataFrame([(1, 2047), (2, 2048), (3, 0), (4, None)], "id long, n long")
    assert rows(sequences.units(df, "id", "n").select("id", "kind", "length")) == [(1, "full", 2048), (2, "full", 2048), (2, "rest", 1), (3, "rest", 1)]
    plan = sequences.schedule(spark.createDataFrame([("a", "s", 10), ("b", "s", 5)], "lane string, shard string, n long"), "lane", "shard", "n", 4, ["b", "a"])
    assert rows(plan) == [(0, "b", "s", 0), (1, "a", "s", 0), (2, "a", "s", 4)]
    first, cursor = sequences.Cursor().draw(plan, 2)
    assert [r[0] for r in rows(first)] == [0, 1] and [r[0] for r in rows(sequences.Cursor.from_dict(cursor.to_dict()).rest(plan))] == [2]
    ids = sequences.unit_tokens(spark.createDataFrame([(1, "abé"), (2, None), (3, "")], "id long, t string"), "id", "t", window=3)
    assert rows(ids) == [(1, 0, [97, 98, 195]), (1, 1, [169, 256]), (3, 0, [256])]
    seq = ids.groupBy().agg(F.array_sort(F.collect_list(F.struct("id", "unit_no", "token_id"))).alias("g")).select(packing.segment_arrays(F.transform("g", lambda x: F.struct(x["id"].alias("doc_id"), x["token_id"].alias("token_id"))), 8, 256).alias("a")).first().a
    assert seq.token_id == [97, 98, 195, 169, 256, 256, 256, 256] and seq.loss_mask == [1] * 6 + [0, 0] and seq.doc_id == [1] * 5 + [3, -1, -1] and seq.position_id == list(range(8))
    losses = spark.createDataFrame([([1.0, 2.0, 9.0], [1, 1, 1, 0]), ([5.0], [1, 0]), ([], [1])], "l array<double>, m array<int>")
    assert [r[0] for r in losses.select(sequences.shifted_masked_mean(F.col("l"), F.col("m"))).collect()] == [1.5, 0.0, 0.0]


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "en" if i % 2 else None) for i in range(25)], "id long, text string, lang string")
    done = tables.write_shards(df, str(tmp_path / "s"), ["id"], 10)
    assert [(r[0], r[1]) for r in rows(done)] == [(0, 10), (1, 10), (2, 5)]
    back = tables.read_shards(spark, str(tmp_path / "s"))
    told = {r.shard_no: r for r in tables.shard_manifest(back.withColumn("n", F.length("text")), "n", "lang").collect()}
    assert told[0].lang_distribution == {"en": 50, "und": 50} and told[2].token_count == 15
    with pytest.raises(FileNotFoundError):
        tables.read_shards(spark, _empty(spark, tmp_path))
    tables.append_jsonl(df.coalesce(1), str(tmp_path / "j"))
    tables.overwrite_jsonl(df.limit(3), str(tmp_path / "k"))
    assert tables.read_jsonl(spark, str(tmp_path / "j"), ["id"]).count() == 25 and tables.read_jsonl(spark, str(tmp_path / "k"), ["id"]).count() == 3
    (tmp_path / "t" / "web" / "english").mkdir(parents=True)
    (tmp_path / "t" / "web" / "english" / "x.txt").write_text("a\nb")
    assert [tuple(r) for r in tables.scan_targets(spark, str(tmp_path / "t"), "web").select("track", "folder", "text").collect()] == [("web", "english", "a\nb")]
    tables.write_routed_texts(df.na.fill("und"), str(tmp_path / "r"), "text", "lang")
    assert spark.read.text(str(tmp_path / "r")).count() == 25
    assert tables.purge_folder(spark, str(tmp_path / "r")) and not (tmp_path / "r").exists()
    sample = tables.read_sample(spark, str(tmp_path / "s"), "id", 7, track="web")
    assert sample.count() == 7 and sample.first().track == "web" and tables.read_sample(spark, str(tmp_path / "s"), "id", 99).count() == 25
    held = spark.createDataFrame([(1, "a", ""), (2, None, "b")], "i long, x string, y string")
    assert rows(tables.held_out(held, "i", "x", "y")) == [(1, "a"), (2, "b")]
    assert rows(tables.prompt_and_solution(held, "i", "x", "y")) == [(1, "a\n"), (2, "\nb")]
    seqs = spark.createDataFrame([("web", 0, i, [i, 1]) for i in range(3)], "lane string, shard_no long, row_no long, token_id array<int>")
    file = tables.export_arrays(seqs, str(tmp_path / "npz"), "lane", ["token_id"]).first().file
    assert np.load(file)["token_id"].tolist() == [[0, 1], [1, 1], [2, 1]]


def _empty(spark, tmp_path):
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "e"))
    return str(tmp_path / "e")


def test_shared_grams_and_firewall(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"x {passage} y", 0), (2, " ".join(passage.split()[:12]), 0), (3, None, 0), (4, "short one", 0)], "id long, text string, gram int")
    held = spark.createDataFrame([(passage,), ("short  one",), ("",), (None,)], "t string")
    assert rows(corpus.shared_grams(docs, "id", "text", held, "t")) == [(1,), (4,)]
    assert audits.firewall_works("f", docs, "id", "text", held, "t").first().passed
    assert not audits.firewall_works("f", docs, "id", "text", held.where("t = ''"), "t").first().passed


def test_audits(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    assert audits.same_rows("s", a, a).first().passed and not audits.same_rows("s", a, a.distinct()).first().passed
    assert not audits.resolves("r", a, "x", a.where("x > 1"), "x").first().passed and audits.resolves("r", a, "x", a, "x").first().passed
    got = {r.check_name: r.passed for r in audits.overall(audits.no_rows("n", a), audits.has_fields("h", a, ["x"])).collect()}
    assert got == {"n": False, "h": True, "overall": False}
    mixed = {r.lane: r.within for r in audits.mixture_within(spark.createDataFrame([("w", 50), ("c", 50)], "lane string, n int"), "lane", "n", {"w": 45.0, "c": 20.0, "i": 5.0}).collect()}
    assert mixed == {"w": True, "c": False, "i": False}


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a  b"), (2, "a b"), (3, "c")], "doc_id long, text string").withColumn("ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    got = []
    query = ingest.run_to(ingest.stream_documents(spark, str(tmp_path / "in"), df.schema), lambda batch, _: got.extend(r.cleaned for r in batch.collect()), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert sorted(got) == ["a b", "c"]


def test_storage(spark):
    with storage.scratch() as kept:
        gone = storage.materialize(spark.range(3).toDF("a"), "x")
        stays = kept.keep(storage.materialize(gone, "y"))
    assert stays.count() == 3 and gone._written not in storage._LIVE
    storage.discard(stays)
    assert stays._written not in storage._LIVE


def test_catalogue_names():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_masked_mean(spark):
    df = spark.createDataFrame([(2.0, 1), (4.0, 0)], "l double, m int")
    assert df.agg(sequences.masked_mean(F.col("l"), F.col("m")).alias("r")).first().r == 2.0
