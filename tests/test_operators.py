import math
import random

import pytest
from pyspark.sql import functions as F

from inkweir.functions import text as tx
from inkweir.functions import urls
from inkweir.operators import cloze, crawl, graph, quality, ranking, validation
from inkweir.operators.ordered import ordinals, prefix_sums


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.A.example/B/?b=2&a=1#top", "example,a)/b?a=1&b=2"), ("https://m.a.example:443", "example,a,m)/"), ("a.example/x/", "example,a)/x"), ("http://u@a.example/x", "example,a)/x"), (None, None), ("", None),
    ],
)
def test_canonical_key(spark, url, key):
    assert one(spark, urls.canonical_key(F.col("u")), u=url) == key


@pytest.mark.parametrize(("url", "ok"), [("http://www.youtube.com/x", False), ("http://m.youtube.com/x", True), ("http://a.example/x.pdf", False), ("http://a.example/x.PDF", True), ("nonsense", False), (None, False)])
def test_scrapable(spark, url, ok):
    assert one(spark, urls.is_scrapable(F.col("u")), u=url) is ok


def test_unwrap_archive(spark):
    assert one(spark, urls.unwrap_archive(F.col("u")), u="https://web.archive.org/web/20080628063306/http://x.example/y") == "http://x.example/y"
    assert one(spark, urls.unwrap_archive(F.col("u")), u="http://web.archive.org/web/20080628063306/http://x.example/y").startswith("http://web")
    assert one(spark, urls.byte_range(F.col("a"), F.col("b")), a=10, b=5) == "bytes=10-14"


def test_text_functions(spark):
    assert one(spark, tx.split_sentences(F.col("t")), t="One. Two!  Three") == ["One.", "Two!", "Three"]
    assert one(spark, tx.token_count(F.col("t")), t=None) == 0
    assert one(spark, tx.categories(F.col("t")), t="[[Category: Living people |Doe]] [[category:no]]") == ["Living people |Doe"]
    assert one(spark, tx.transliterate(F.col("t")), t="Größe «ñ»") == "Grosse <<n>>"
    marks = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(o).alias("offset")) for i, o in ((2, 3), (1, 0))))
    assert one(spark, tx.splice_citations(F.col("t"), marks), t="abcdef") == "[1]abc[2]def"
    assert [one(spark, tx.decode_label(F.col("t")), t=a) for a in ("Yes", "No", "Unclear", None)] == [1, 0, -1, -1]


def test_prefix_sums_and_ordinals(spark):
    random.seed(1)
    values = [(i, random.randint(0, 9)) for i in range(500)]
    random.shuffle(values)
    df = spark.createDataFrame(values, "i int, v int")
    got = {r["i"]: r["s"] for r in prefix_sums(df, ["i"], partitions=7, s=F.col("v")).collect()}
    run = 0
    for i, v in sorted(values):
        run += v
        assert got[i] == run
    assert sorted(r["ordinal"] for r in ordinals(df, ["i"]).collect()) == list(range(500))
    assert prefix_sums(df.where("false"), ["i"], s=F.col("v")).count() == 0


def test_connected_components_equal_union_find(spark):
    random.seed(2)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {k: v for k, v in got.items() if k in parent} == {k: find(k) for k in parent}
    assert graph.connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("target", [0, 5, 1000])
def test_fill_splits(spark, target):
    sizes = [(i, 1 + i % 4) for i in range(40)]
    got = {r["component"]: r["split"] for r in graph.fill_splits(spark.createDataFrame(sizes, "component bigint, n bigint"), [("valid", target), ("test", target)], "train", F.col("component")).collect()}
    left, want = sorted(sizes), {}
    for name in ("valid", "test"):
        total, k = 0, 0
        while k < len(left) and (total < target or k == 0):
            want[left[k][0]] = name
            total += left[k][1]
            k += 1
        left = left[k:]
    want |= {c: "train" for c, _ in left}
    assert got == want


def test_bm25_equals_the_formula(spark):
    docs = {1: "a b b c", 2: "b d", 3: "", 4: "a a a"}
    frame = spark.createDataFrame([*docs.items(), (5, None)], "doc_id bigint, text string")
    pairs = spark.createDataFrame([(9, d, "b A a z") for d in docs], "query_id bigint, doc_id bigint, query string")
    stats, df = ranking.corpus_stats(frame), ranking.document_frequency(frame)
    n, avg = stats.first()
    assert (n, avg) == (5, 9 / 5)
    known = {r["word"]: r["df"] for r in df.collect()}
    got = {r["doc_id"]: r["score"] for r in ranking.bm25(pairs, frame, df, stats).collect()}
    for d, t in docs.items():
        want = 0.0
        for w in {"b", "a", "z"}:
            tf, f = t.split().count(w), known.get(w, 0)
            want += math.log((n + f + 0.5) / (f + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t.split()) / avg))
        assert got[d] == pytest.approx(want)


def test_buckets_put_a_score_at_a_cut_below_it(spark):
    scores = spark.createDataFrame([(float(i),) for i in range(11)], "score double")
    cuts = ranking.score_cuts(scores)
    assert {r["score"]: r["bucket"] for r in ranking.bucket(scores, cuts).collect()}[1.0] == 0


def test_pr_curve_and_route(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "score double, label int")
    curve = {r["threshold"]: (r["precision"], r["recall"]) for r in quality.pr_curve(rows).collect()}
    assert curve == {0.9: (1.0, 0.5), 0.8: (2 / 3, 1.0), 0.1: (0.5, 1.0)}
    assert quality.average_precision(quality.pr_curve(rows)).first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    routed = quality.route(spark.createDataFrame([(1, 0, 1.1), (1, 1, 0.2), (2, 0, 0.3)], "id int, doc_index int, score double"), 1.1, "id")
    assert {r["id"]: (r["good"], r["bad"]) for r in routed.collect()} == {1: ([0], [1]), 2: ([], [0])}


def test_training_leaves_infinite_features_out(spark):
    random.seed(3)
    rows = [(random.randint(0, 50), random.randint(1, 30), random.random() * 9, random.choice([None, 10])) for _ in range(300)]
    df = quality.features(spark.createDataFrame([(*r, int(r[2] > 4)) for r in rows], "document_tokens int, sentence_tokens int, score double, views int, label int"))
    out = quality.decision(df, quality.train(df)).collect()
    assert len(out) == sum(r[0] > 0 for r in rows)
    assert sum((r["decision"] > 0) == (r["label"] == 1) for r in out) > 0.9 * len(out)


def test_citation_at_a_boundary_belongs_to_both_sentences(spark):
    rows = spark.sql("SELECT 'abc. def.' AS text, array(named_struct('start', 0, 'end', 4), named_struct('start', 4, 'end', 9)) AS spans, array(named_struct('reference_id', 1, 'offset', 4), named_struct('reference_id', 2, 'offset', 9), named_struct('reference_id', 3, 'offset', 9)) AS citations")
    got = sorted((r["sentence_no"], list(r["ids"])) for r in cloze.cited_sentences(rows).collect())
    assert got == [(0, [1]), (1, [1]), (1, [2, 3])]
    assert sorted((r["sentence_no"], list(r["ids"])) for r in cloze.cited_sentences(rows, "sentence").collect()) == [(0, [1]), (1, [1, 2, 3])]


def test_regroup_is_idempotent(spark):
    doc = "array(named_struct('canonical_url', '{}', 'n', {}))"
    rows = spark.sql(" UNION ALL ".join(f"SELECT {i} AS no, {p} AS page_id, array('a') AS context, array('{z}') AS cloze, {doc.format(u, i)} AS documents" for i, p, z, u in ((1, "7", "x", "u"), (2, "7", "x", "v"), (3, "7", "x", "u"), (4, "NULL", "x", "u"), (5, "7", "y", "w"))))
    once = cloze.regroup(rows, "no")
    assert {r["no"]: [d["canonical_url"] for d in r["documents"]] for r in once.collect()} == {1: ["u", "v"], 4: ["u"], 5: ["w"]}
    assert sorted(cloze.regroup(once, "no").collect()) == sorted(once.collect())


def test_crawl(spark):
    index = spark.createDataFrame([("k", 1, 404), ("k", 2, 200), ("k", 3, 200), ("z", 1, 200)], "k string, line int, status int")
    assert [(r["k"], r["line"]) for r in crawl.first_match(index, spark.createDataFrame([("k",)], "k string"), ["k"], ["line"]).collect()] == [("k", 2)]
    assert {r["k"]: r["line"] for r in crawl.last_wins(index, "k", ["line"]).collect()} == {"k": 3, "z": 1}
    pairs = crawl.next_offsets(spark.createDataFrame([(5,), (5,), (1,), (None,), (9,)], "start bigint")).collect()
    assert sorted((r["start"], r["end"]) for r in pairs if r["end"]) == [(1, 5), (5, 9)]


def test_rules_and_shared_keys(spark):
    rows = spark.sql("SELECT 'i' AS id, ' ' AS page_title, CAST(NULL AS BIGINT) AS page_id, array('a', '') AS left_context, 'c' AS cloze, array(named_struct('canonical_url', 'u')) AS documents")
    got = {r["rule"]: r["violations"] for r in validation.rule_violations(rows).collect()}
    assert got == {"id": 0, "page_title": 1, "page_id": 1, "left_context": 1, "cloze": 0, "documents": 0}
    assert all(r["violations"] == 0 for r in validation.rule_violations(rows.where("false")).collect())
    shared = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", None), ("a", None)], "split string, page bigint")
    assert [tuple(r) for r in validation.shared_keys(shared, "split", ["page"]).collect()] == [("page", "a", "b", 1)]


def test_urls_that_are_not_scraped(spark):
    from inkweir.functions import urls

    told = {
        "https://books.google.co.in/books?id=1": False, "http://www.youtube.com/watch": False, "http://books.google.com/": False, "http://twitter.com/x": True, "http://a.example/x.gif": True, "http://a.example/x.docx": False,
        "http://a.example/x.pptx": False, "http://a.example/x.xlsx": False, "http://a.example/x.PDF": True, "http://m.youtube.com/": True, "a.example/x": False,
    }
    rows = spark.createDataFrame([(u,) for u in told], "u string").select("u", urls.is_scrapable(F.col("u")).alias("s")).collect()
    assert {r["u"]: r["s"] for r in rows} == told


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from inkweir import session

    conf = SimpleNamespace(get=lambda k, d=None: d)
    made = []
    at = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: made[-1] if made else None, getConf=lambda: conf, setCheckpointDir=made.append)
    cluster = SimpleNamespace(sparkContext=at, conf=conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)
    at.master = "local-cluster[3,4,6144]"
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(cluster)
    cluster.conf = SimpleNamespace(get=lambda k, d=None: "hdfs://shared/x")
    assert session.ensure_checkpoint_dir(cluster) == "hdfs://shared/x"


def test_hot_nodes_are_joined_in_parts(spark, monkeypatch):
    from inkweir.operators import graph

    monkeypatch.setattr(graph, "HOT_DEGREE", 5)
    star = [(1, k) for k in range(100, 300)] + [(k, k + 1000) for k in range(100, 200)] + [(7, 8), (8, 9), (50, 50)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(star, "u bigint, v bigint")).collect()}
    assert got == {1: 1} | {k: 1 for k in range(100, 300)} | {k + 1000: 1 for k in range(100, 200)} | {7: 7, 8: 7, 9: 7, 50: 50}


def test_quantiles_equal_numpy(spark):
    import numpy as np

    from inkweir.operators import ranking

    values = [3.0, 1.0, 1.0, 2.5, 9.0, 4.0, 4.0, 4.0, -1.0, 0.5, 7.0]
    row = ranking.score_cuts(spark.createDataFrame([(v,) for v in [*values, None]], "score double")).first()
    assert (row["low"], row["high"]) == (-1.0, 9.0) and np.allclose(row["cuts"], np.quantile(values, np.arange(1, 10) / 10))
    assert tuple(ranking.score_cuts(spark.createDataFrame([], "score double")).first()) == (None, None, None)
    assert ranking.score_cuts(spark.createDataFrame([(2.0,)], "score double")).first()["cuts"] == [2.0] * 9


def test_models_are_kept_and_rows_held_out(spark, tmp_path):
    import random

    from inkweir.operators import quality

    random.seed(3)
    rows = spark.createDataFrame([(k, *(random.random() + (k % 2) for _ in range(4)), k % 2) for k in range(300)], "k int, " + ", ".join(f"{f} double" for f in quality.FEATURES) + ", label int")
    train, held = quality.hold_out(rows, 50, "k")
    assert (train.count(), held.count(), train.join(held, "k").count()) == (250, 50, 0)
    quality.save_model(quality.train(train), str(tmp_path / "m"))
    scored = quality.decision(held, quality.load_model(str(tmp_path / "m")))
    assert scored.where("(decision > 0) = (label = 1)").count() > 40
    row = quality.correlation(spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0), (5.0, 6.0), (None, 1.0)], "x double, y double"), "x", "y").first()
    assert (round(row["r"], 6), row["n"], round(row["p"], 6)) == (0.821995, 5, 0.087707)
    assert quality.correlation(rows.where("false"), "k", "label").first()["p"] is None


def test_runs_within_and_across_keys(spark):
    from inkweir.operators.ordered import runs

    rows = [(1, k, v) for k, v in enumerate([None, None, "a", "a", "b", None, "b"])] + [(2, 100 + k, v) for k, v in enumerate("bbaab")] + [(3, 200, None)]
    got = sorted(tuple(r) for r in runs(spark.createDataFrame(rows, "k int, o bigint, v string"), "k", "o", "v").collect())
    assert got == [(1, 0, 2, 0), (1, 1, 2, 2), (1, 2, 1, 4), (1, 3, 1, 5), (1, 4, 1, 6), (2, 1, 2, 100), (2, 2, 2, 102), (2, 3, 1, 104), (3, 0, 1, 200)]
    assert runs(spark.createDataFrame([], "k int, o bigint, v string"), "k", "o", "v").count() == 0


def test_languages_by_profiles_on_unseen_texts(spark):
    from inkweir.functions.language import language_of, languages_of, train_profiles

    told = {
        "en": ["The council opened the new bridge after the war and the people went to the old house.", "There was nothing that they could have done with what was left of the harbour."],
        "de": ["Der Rat der Stadt hat die neue Brücke nach dem Krieg eröffnet und die Leute gingen nach Hause.", "Es gab nichts, was sie mit dem Rest des Hafens hätten machen können."],
        "fr": ["Le conseil de la ville a ouvert le nouveau pont après la guerre et les gens sont rentrés.", "Il n'y avait rien qu'ils auraient pu faire avec ce qui restait du port."],
    }
    profiles = train_profiles(spark.createDataFrame([*((t, c) for c, ts in told.items() for t in ts), (None, "en"), ("x", None), ("", "en")], "text string, language string"))
    assert profiles.languages == ["de", "en", "fr"]
    texts = {"the people of that town have left their bridge": "en", "die Leute der Stadt haben ihre Brücke verlassen": "de", "les gens de cette ville ont quitté leur pont": "fr", "": None, "123": None, "字字字": None}
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert {r["t"]: r["l"] for r in df.select("t", language_of(F.col("t"), profiles).alias("l")).collect()} == {**texts, None: None}
    arrays = spark.createDataFrame([([*texts],), (None,), ([],)], "a array<string>")
    assert [r[0] for r in arrays.select(languages_of(F.col("a"), profiles)).collect()] == [[*texts.values()], None, []]
    nothing = train_profiles(spark.createDataFrame([], "text string, language string"))
    assert nothing.language("the people") is None
