"""The operators for training data against brute force, with the rows that usually break things."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkweir.llm import common, grouped_splits, junk, language, leaks, line_model, main_body, overlap, packing, site_lines, truncation

DOC = "doc_id bigint, canonical_url string, source string, title string, lang string, text string, paragraphs array<array<string>>"
#: Columns whose names the operators use inside.
CLASHING = ["site", "rep", "words", "pos", "token", "tokens", "n", "rank", "bucket", "label", "path", "kind", "seed", "block", "size", "key", "term", "shift"]
EN = ["The council of Aaa opened the new bridge after the war.", "More than 300 people have visited the old museum since 1990.", "According to the report, the harbour was closed in the winter of 1950.", "It was the second time that the library had been moved."]
DE = ["Der Rat der Stadt hat die neue Brücke nach dem Krieg eröffnet.", "Mehr als 300 Menschen haben das alte Museum seit dem Jahr besucht.", "Nach dem Bericht wurde der Hafen im Winter geschlossen und nicht wieder geöffnet."]


def clash(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING if c not in df.columns))


def docs(spark, rows):
    return clash(spark.createDataFrame([(i, u, None, t, lang, text, paras) for i, u, t, lang, text, paras in rows], DOC))


def odd_documents(spark, extra=()):
    """Nulls in every column, empty and very long texts, repeated rows."""
    long = " ".join(EN * 3000)
    rows = [
        (1, "example,a)/1", "T", "en", EN[0] + "\n\n" + EN[1], [[EN[0]], [EN[1]]]), (1, "example,a)/1", "T", "en", EN[0] + "\n\n" + EN[1], [[EN[0]], [EN[1]]]), (2, "example,a)/2", "", "", "", []),
        (3, None, None, None, None, None), (4, "nonsense", "T", "und", " \n ", [[], [None], [""], None]), (5, "example,b)/5", "T", "en", long, [[long]]), (None, "example,a)/n", "T", "en", EN[2], [[EN[2]]]), *extra,
    ]
    return docs(spark, rows)


def invented():
    """A name of its own nearly every time, of varying length, as in a real corpus."""
    return "".join(random.choice("bdfgklmnprstvz") + random.choice("aeiou") for _ in range(random.randint(2, 6))).capitalize()


# ---------------------------------------------------------------- common


def test_line_key_and_words(spark):
    df = spark.createDataFrame([(" Read 12 \t times\n",)], "s string")
    assert df.select(common.line_key(F.col("s"))).first()[0] == "read 0 times"
    assert common.plain_words("Éric's Über-42 naïve") == ["eric", "s", "uber", "42", "naive"]
    assert common.plain_words(None) == []


def test_hashed_sample_is_bounded_and_the_same_every_time(spark):
    df = spark.range(20_000).toDF("doc_id")
    a, b = (sorted(r[0] for r in common.hashed_sample(df, "doc_id", 1000).collect()) for _ in range(2))
    assert a == b and 850 < len(a) < 1150
    assert common.hashed_sample(df, "doc_id", 50_000).count() == 20_000
    long = df.withColumn("text", F.repeat(F.lit("x"), 1000)).unionByName(spark.createDataFrame([(30_000, "y" * 2_000_000)], "doc_id bigint, text string"))
    few = common.hashed_sample(long, "doc_id", 50_000, 1_000_000)
    assert 800 < few.count() < 1100 and few.where("doc_id = 30000").count() == 0


# ---------------------------------------------------------------- repeated lines


def brute_lines(rows, least, share):
    key = lambda s: re.sub(r"[\s ]+", " ", re.sub(r"\d+", "0", s.lower())).strip()
    where, site_docs = {}, {}
    for d, u, *_, paras in rows:
        m = re.match(r"([^,)/]+),([^,)/:]+)", u or "")
        if m and d is not None:
            site_docs.setdefault(m[2], set()).add(d)
            for p, para in enumerate(paras or []):
                for s, x in enumerate(para or []):
                    if x is not None:
                        where.setdefault((m[2], key(x)), set()).add((d, p, s))
    return {at for (site, _), found in where.items() if len({d for d, _, _ in found}) >= max(least, share * len(site_docs[site])) for at in found}


def test_repeated_lines_equal_brute_force(spark):
    random.seed(4)
    notes = [f"Read {{}} times on page {k} of the site." for k in range(6)]
    rows = [(i, f"example,s{i % 3})/{i}", "t", "en", "", [[random.choice(notes).format(random.randint(1, 99))] + random.sample(EN, 1), [f"only here {chr(97 + i % 26)}x{chr(97 + i // 26)}", "  Legal   NOTICE "]]) for i in range(60)]
    rows += [(100, "example,s0)/x", "t", "en", "", None), (101, "example,s0)/y", "t", "en", "", [[None], []]), rows[0]]
    got = {tuple(r) for r in site_lines.repeated_lines(docs(spark, rows), 5, 0.2).select("doc_id", "para_no", "sent_no").collect()}
    assert got == brute_lines(rows, 5, 0.2)
    named = [(i, f"example,s)/{i}", "t", "en", "", [[f"thanks for reading dear n{chr(97 + i % 26)}{chr(97 + i // 26)} today"]]) for i in range(40)]
    assert [r["slots"] for r in site_lines.line_templates(docs(spark, named), 5, 0.2)[0].collect()] == [1]
    clean = {r["doc_id"]: r["paragraphs"] for r in site_lines.without_lines(docs(spark, rows), site_lines.repeated_lines(docs(spark, rows), 5, 0.2)).collect()}
    assert clean[7][-1] == ["only here hxa"] and clean[100] is None


def test_slotted_templates_are_removed_and_wildcards_are_tokens(spark):
    names = [f"n{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    rows = [(i, f"example,s)/{i}", "t", "en", "", [[f"thanks for reading dear {n} today", f"{n} has <*> here", "so much for <*> now", f"{n} one {n} two {n} three"]]) for i, n in enumerate(names)]
    df = docs(spark, rows)
    assert {(r["template"], r["slots"]) for r in site_lines.line_templates(df)[0].collect()} == {("thanks for reading dear <*> today", 1), ("so much for <*> now", 0)}
    assert {r["sent_no"] for r in site_lines.repeated_lines(df).collect()} == {2}
    assert {r["sent_no"] for r in site_lines.templated_lines(df).collect()} == {0, 2}
    kept = site_lines.without_lines(df, site_lines.templated_lines(df)).where("doc_id = 3").first()["paragraphs"]
    assert kept == [[f"{names[3]} has <*> here", f"{names[3]} one {names[3]} two {names[3]} three"]]


def test_hot_leaves_and_lines_in_parts(spark, monkeypatch):
    random.seed(14)
    rows = [(i, f"example,s{0 if i < 60 else i % 4})/{i}", "t", "en", "", [["Read more on this site", f"own {i} line {chr(97 + i % 26)}"], [random.choice(EN)]]) for i in range(120)]
    want = brute_lines(rows, 5, 0.1)
    monkeypatch.setattr(site_lines, "SENT_BYTES", -1)
    monkeypatch.setattr(site_lines, "HOT_ROWS", 10)
    assert {tuple(r) for r in site_lines.repeated_lines(docs(spark, rows), 5, 0.1).select("doc_id", "para_no", "sent_no").collect()} == want


def test_repeated_lines_of_odd_documents(spark):
    df = odd_documents(spark)
    assert site_lines.repeated_lines(df, 2, 0.0).count() == 0
    assert site_lines.repeated_lines(df.where("false")).count() == 0
    assert {r["doc_id"] for r in site_lines.repeated_lines(df, 1, 0.0).collect()} >= {1, 5}


# ---------------------------------------------------------------- overlaps


def records(spark, rows):
    return clash(spark.createDataFrame(rows, "rec_id bigint, split_name string, text string"))


def brute_pairs(rows, least=0.7):
    sets = [(i, s, set(common.plain_words(t))) for i, s, t in rows if i is not None and s and common.plain_words(t)]
    return {(min(a, b), max(a, b)) for a, s, x in sets if s == "train" for b, t, y in sets if t != "train" and 10 * len(x & y) >= round(10 * least) * len(x | y)}


def test_overlaps_equal_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(0, 300, 3):
        base = random.choices(vocabulary, k=random.choice([3, 5, 8, 20, 30]))
        edited = list(base)
        for _ in range(max(0, len(base) // 10)):
            edited[random.randrange(len(base))] = random.choice(vocabulary)
        rows += [(i, "train", " ".join(base)), (i + 1, random.choice(["valid", "test"]), " ".join(edited).upper() + "."), (i + 2, "train", "on the other hand " + " ".join(random.choices(vocabulary, k=12)))]
    rows += [(1000, None, rows[0][2]), (1001, "test", None), (1002, "test", ""), (1003, "test", " .,- "), (None, "train", rows[0][2]), rows[0], (1004, "valid", "one"), (1005, "train", "One!")]
    got = {(r["rec_id_a"], r["rec_id_b"]) for r in overlap.overlapping_pairs(records(spark, rows)).collect()}
    assert got == brute_pairs(rows)


def test_overlaps_without_a_common_run(spark, monkeypatch):
    random.seed(15)
    vocabulary = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(0, 240, 2):
        base = random.sample(vocabulary, random.randint(14, 30))
        other = [w for k, w in enumerate(base) if k % 4 != 3] if i % 4 else [w if k % 5 else random.choice(vocabulary) for k, w in enumerate(base)]
        if i % 3 == 0:
            random.shuffle(other)  # the same words in any order
        rows += [(i, "train", " ".join(base)), (i + 1, "test", " ".join(other))]
    want = brute_pairs(rows)
    got = lambda: {(r["rec_id_a"], r["rec_id_b"]) for r in overlap.overlapping_pairs(records(spark, rows)).collect()}
    assert got() == want and len(want) > 60
    monkeypatch.setattr(overlap, "HOT", 0)
    monkeypatch.setattr(overlap, "COUNTERS", 16)  # every seed is frequent
    assert got() == want


def test_coverage_per_record(spark):
    rows = [(1, "train", "a b c d e f g h i j"), (2, "train", "a b c d e f g h i j"), (3, "test", "a b c d e f g x i j"), (4, "valid", "nothing like it"), (5, "test", "A B C d e f g h i j")]
    got = {r["rec_id"]: r for r in overlap.record_coverage(records(spark, rows)).collect()}
    assert set(got) == {3, 4, 5}
    assert (got[3]["n_classes"], got[3]["n_train"], got[3]["matched"], got[3]["coverage"]) == (1, 2, 9, 0.9)
    assert (got[4]["n_train"], got[4]["coverage"]) == (0, 0) and (got[5]["n_train"], got[5]["coverage"]) == (2, 1)
    assert overlap._common(list("abcbdab"), list("bdcaba")) == 4 and overlap._common([], ["a"]) == 0


def test_copies_are_one_class_and_long_texts_pass(spark):
    long = " ".join(f"v{k % 997}" for k in range(30_000))
    rows = [(i, "train", "the same old story of the town") for i in range(50)] + [(60, "test", "The same old story of the town"), (61, "train", long), (62, "test", long + " end")]
    classes, links = overlap.cross_split_overlaps(records(spark, rows))
    assert {r["rep"] for r in classes.where("rec_id <= 60").collect()} == {0}
    assert sorted((r["rep_eval"], r["rep_train"]) for r in links.collect()) == [(0, 0), (62, 61)]
    assert links.where("rep_eval = 62").first()["matched"] == 30_000
    assert overlap.overlapping_pairs(records(spark, [])).count() == 0


def test_chain_is_collinear():
    assert overlap.chain([0, 5, 2, 9, 3], [1, 2, 6, 8, 7]) in ([(0, 1), (2, 6), (3, 7), (9, 8)],)
    assert overlap.chain([-1], [3]) == []
    assert overlap.aligned("a b c d e".split(), "a x c d e".split(), [(2, 2)]) == 4


# ---------------------------------------------------------------- grouped splits


def linked(spark, rows):
    return clash(spark.createDataFrame(rows, "rec_id bigint, entity bigint, sources array<string>"))


@pytest.mark.parametrize("hot", [100_000, 3])
def test_groups_equal_union_find_and_splits_keep_them(spark, monkeypatch, hot):
    monkeypatch.setattr(grouped_splits, "HOT_ROWS", hot)
    random.seed(6)
    rows = [(i, random.choice([None, 1, *range(2, 200)]), [random.choice([None, f"u{random.randint(0, 900)}"]) for _ in range(random.randint(0, 2))]) for i in range(1, 500)]
    rows += [(600, None, None), (601, None, []), rows[0], (None, 5, ["u1"])]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, e, us in rows:
        if i is not None:
            for k in [("e", e)] * (e is not None) + [("u", u) for u in us or [] if u is not None]:
                parent[find(("i", i))] = find(k)
            find(("i", i))
    least = {}
    for i, *_ in rows:
        if i is not None:
            least[find(("i", i))] = min(i, least.get(find(("i", i)), i))
    groups = grouped_splits.record_groups(linked(spark, rows))
    got = {r["rec_id"]: r["group_no"] for r in groups.collect()}
    assert got == {i: least[find(("i", i))] for i, *_ in rows if i is not None}
    labels = spark.createDataFrame([(i, random.choice(["train", "valid", "test", None])) for i in got], "rec_id bigint, label string")
    placed = grouped_splits.split_groups(clash(groups), labels).collect()
    assert len(placed) == len(got)
    assert len({(r["group_no"], r["split"]) for r in placed}) == len(set(got.values()))
    again = grouped_splits.split_groups(groups, labels)
    assert sorted(again.collect()) == sorted(placed)
    assert grouped_splits.record_groups(linked(spark, [])).count() == 0


def test_allocation_meets_quotas():
    shares = {"train": 0.8, "valid": 0.1, "test": 0.1}
    bundles = [(1, (1, 0, 0), 700), (1, (0, 1, 0), 50), (2, (0, 0, 2), 60), (5, (0, 0, 0), 20), (30, (30, 0, 0), 1)]
    plan = grouped_splits.allocate(bundles, shares)
    load = {s: sum(size * n[s] for (size, _), n in plan.items()) for s in shares}
    assert load == {"train": 800, "valid": 100, "test": 100}
    assert plan[1, (0, 1, 0)]["valid"] == 50 and plan[2, (0, 0, 2)]["test"] == 50
    one = grouped_splits.allocate([(100, (100, 0, 0), 1)], shares)
    assert one[100, (100, 0, 0)]["train"] == 1
    assert grouped_splits.allocate([], shares) == {}


def test_allocation_reads_the_whole_profile():
    shares = {"train": 0.5, "valid": 0.25, "test": 0.25}
    # most records of both were in train, but the second costs less in test
    plan = grouped_splits.allocate([(10, (6, 4, 0), 2), (10, (6, 0, 4), 2), (10, (10, 0, 0), 4)], shares)
    assert plan[10, (6, 4, 0)] == {"train": 0, "valid": 2, "test": 0} and plan[10, (6, 0, 4)] == {"train": 0, "valid": 0, "test": 2}
    # without a price on deviation nothing moves
    assert grouped_splits.allocate([(10, (10, 0, 0), 8)], shares, deviation=0.0)[10, (10, 0, 0)]["train"] == 8


# ---------------------------------------------------------------- leaks


def brute_leaks(documents, items, run):
    grams = {}
    for i, t in items:
        w = common.plain_words(t)
        for k in range(len(w) - run + 1):
            grams.setdefault(tuple(w[k : k + run]), set()).add(i)
    return {(d, i) for d, t in documents if d is not None for w in [common.plain_words(t)] for k in range(len(w) - run + 1) for i in grams.get(tuple(w[k : k + run]), ())}


def test_leaks_equal_brute_force(spark):
    random.seed(7)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(random.choices(vocabulary, k=30))) for i in range(20)] + [(50, None), (51, ""), (52, "too short"), (0, None)]
    texts = []
    for d in range(120):
        words = random.choices(vocabulary, k=40)
        if d % 3 == 0:
            source = common.plain_words(items[d % 20][1])
            start, n = random.randrange(15), random.choice([11, 12, 15])
            words[10:10] = source[start : start + n]
        texts.append((d, ", ".join(words).upper() + "\n\n.") if d % 2 else (d, "\n".join(words)))
    texts += [(300, None), (301, ""), (None, texts[0][1]), texts[0], (302, items[0][1] * 200)]
    documents = clash(spark.createDataFrame(texts, "doc_id bigint, text string"))
    asked = clash(spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(documents, asked, 12).collect()}
    assert got == brute_leaks(texts, items, 12) and len(got) > 20
    near = {(r["doc_id"], r["item_id"]) for r in leaks.near_items(documents, asked, 12).collect()}
    assert got <= near
    assert leaks.leaked_items(documents.where("false"), asked).count() == 0
    assert leaks.leaked_items(documents, asked.where("false")).count() == 0


def test_near_items_need_three_terms(spark):
    words = [f"x{k}" for k in range(12)]
    common = [(k, f"x{k}") for k in range(3, 12)] + [(20 + k, f"x{k}") for k in range(3, 12)]
    documents = spark.createDataFrame([*common, (100, "x0 x1 and nothing else"), (101, "x0 x1 so x2 x4")], "doc_id bigint, text string")
    near = leaks.near_items(documents, spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string"), 12)
    assert [tuple(r) for r in near.collect()] == [(101, 7, 3)]


def test_leaks_without_sending_the_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(leaks, "SENT_BYTES", -1)
    monkeypatch.setattr(leaks, "HOT_TERM", 2)
    text = " ".join(f"x{k}" for k in range(20))
    documents = spark.createDataFrame([(1, text), (2, "y " + text[9:])], "doc_id bigint, text string")
    got = leaks.leaked_items(documents, spark.createDataFrame([(7, text)], "item_id bigint, text string"), 12)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7, 20), (2, 7, 17)]


# ---------------------------------------------------------------- truncation


def test_truncated(spark):
    random.seed(8)
    names = ["Aaa", "Bbb", "Ccc", "Ddd"]
    sentence = lambda: random.choice(["The council of {} said that the bridge near {} was closed.", "According to {}, the museum in {} opened the new hall after the war."]).format(invented(), invented())
    rows = [(i, f"example,s{i % 4})/{i}", "t", "en", "\n\n".join(sentence() for _ in range(4)) + ("" if i % 2 else f"\n\nRelated: {random.choice(names)} and the bridge"), []) for i in range(400)]
    cut = {1000: sentence() + "\n\nThe council of Aaa said that the", 1001: sentence() + " According to Bbb, the museum in Ccc opened the new ha<br", 1002: sentence() + " The council of Ddd said that the br... (more)"}
    whole = {1010: "The council of Aaa said that the bridge near Bbb was closed...", 1011: sentence() + "\n\nRelated: Aaa and the bridge", 1012: sentence()}
    rows += [(i, "example,s1)/x", "t", "en", t, []) for i, t in (cut | whole).items()]
    limited = [(2000 + k, "example,lim)/x", "t", "en", " ".join(sentence() for _ in range(12))[:300 + k % 3 * 0], []) for k in range(12)]
    rows += limited + [(3000, None, None, None, None, None), (3001, "example,s1)/e", "t", "en", "", []), (3002, "example,s1)/e", "t", "en", " \n", []), (None, "example,s1)/e", "t", "en", "the", []), rows[0]]
    got = {r["doc_id"]: r["reason"] for r in truncation.truncated(docs(spark, rows)).collect()}
    assert {k for k in got if k < 2000} == set(cut)
    assert {k for k in got if 2000 <= k} == {r[0] for r in limited}
    assert got[1001] == got[1002] == "mark" and got[1000] == "gram"


def test_truncation_of_odd_documents(spark):
    assert truncation.truncated(odd_documents(spark).where("false")).count() == 0
    assert {r["doc_id"] for r in truncation.truncated(odd_documents(spark)).collect()} <= {1, 5}


# ---------------------------------------------------------------- lines, residue, bodies


@pytest.fixture(scope="module")
def news(spark):
    """A small corpus of prose, furniture, filler and error pages on several hosts."""
    random.seed(9)
    names = [a + b for a in ("Kal", "Mir", "Tor", "Ves") for b in ("dan", "lin", "mo", "rik")]
    prose = ["The council of {} opened the new bridge after the war.", "More than {} people have visited the museum of {} since 1990.", "According to {}, the harbour in {} was closed during the winter.", "Few remember that {} painted the old library of {} in spring."]
    errors = ["The page you requested could not be found on this server.", "Service temporarily unavailable, please try again in 5 minutes.", "An unexpected error occurred while processing the request."]
    filler = ["Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Ut enim ad minim veniam, quis nostrud exercitation ullamco.", "Duis aute irure dolor in reprehenderit in voluptate velit."]
    line = lambda: random.choice(prose).format(invented(), invented())
    rows = []
    for i in range(600):
        host = f"h{i % 12}"
        notes = [f"Sign up for the {host.upper()} letter and never miss a story.", f"Copyright 2014 {host}. All rights reserved.", "Home / News / Sport / Contact"]
        kind = "error" if i % 20 == 3 else "filler" if i % 20 == 7 else "prose"
        body = [[random.choice(errors)]] if kind == "error" else [random.sample(filler, 2)] if kind == "filler" else [[line() for _ in range(random.randint(2, 4))] for _ in range(3)]
        title = "404 Not Found" if kind == "error" else f"How {random.choice(names)} lost the bridge"
        rows.append((i, f"example,{host})/{i}", title, "en", "", [[random.choice(notes)], *body, [random.choice(notes)]]))
    return rows


def test_residue(spark, news):
    said = "Writers in Kaldan are told to write {{name}} where the reader stands, Mirlin explained in the spring."
    extra = [
        (2000, "example,h1)/x", "How Mirlin lost the bridge", "en", "", [[EN[0], "Dear {{name}},"]]), (2001, "example,h1)/x", "{{headline}}", "en", "", [[EN[0]]]), (2002, "example,h1)/x", "Access Denied", "en", "", []),
        (2003, "example,h1)/x", "How Mirlin lost the bridge", "en", "", []), (2004, "example,h1)/x", "How Mirlin lost", "en", "", [[EN[0], said]]), (2005, "example,h1)/x", None, None, None, None), (2006, None, "", "en", "", [[None], None, []]),
        (2007, "example,h1)/x", "Page not found", "en", "", [["Copyright 2014 h1. All rights reserved."]]), (None, "example,h1)/x", "Access Denied", "en", "", []),
    ]
    got = {r["doc_id"]: r["residue"] for r in junk.residue_documents(docs(spark, news + extra)).collect()}
    want = {r[0]: r[0] % 20 in (3, 7) for r in news} | {2000: True, 2001: True, 2002: True, 2003: False, 2004: False, 2005: False, 2006: False, 2007: True}
    assert got == want
    assert junk.residue_documents(docs(spark, [])).count() == 0


def test_repetition_is_counted_beyond_the_sample(spark):
    seen = {r[0] for r in common.hashed_sample(spark.range(1000).toDF("doc_id"), "doc_id", 100).collect()}
    inside, outside = sorted(seen), [i for i in range(1000) if i not in seen]
    notice, shared, own = "The editors of this paper wish all readers a pleasant day.", "The agency sent this same report to all of its papers.", "The council of Mirlin opened the new bridge after the war."
    lines = {inside[0]: [notice, own], inside[1]: [shared, own + " x."]} | {i: ["  " + notice.upper(), "x"] for i in outside[:2]} | {i: [shared, "y"] for i in outside[2:4]}
    shell = ["Lorem ipsum dolor sit amet, consectetur adipiscing elit."]
    host = {inside[0]: "a", outside[0]: "a", outside[1]: "a"} | {outside[6]: "b", outside[7]: "c"}
    title = {inside[2]: "Odd shell", outside[6]: "Odd shell - B", outside[7]: "Odd shell"}
    rows = [(i, f"example,{host.get(i, f's{i}')})/{i}", title.get(i, "T"), "en", "", [lines.get(i, shell if i in title else [f"n{i}"]), None]) for i in range(1000)]
    sample = line_model.sample_lines(docs(spark, rows), 100)
    assert set(sample["doc_id"]) == seen
    label = dict(zip(sample["sent"], sample["label"]))
    assert (label[notice], label[shared], label[own]) == (line_model.FURNITURE, -1, line_model.PROSE)
    model = line_model.LinearModel(np.zeros((line_model.SLOTS, 6), np.float32), np.array([0, 0, 1, 0, 0, 0], np.float32))
    assert junk.title_hosts(docs(spark, rows), {"Odd shell"}, model) == {"Odd shell": 3}


def test_line_model_holds_on_unseen_hosts(spark, news):
    table = junk.validate_on_unseen_hosts(docs(spark, news)).set_index("judged")
    for c in ("prose", "furniture", "filler", "error", "residue"):
        row = table.loc[c]
        assert row.n_right >= 0.95 * row.n_truth and row.n_right >= 0.95 * row.n_found


def test_main_body(spark, news):
    page = """<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body><ul><li><a href="/">Home</a><li><a href=/>News</a></ul><h1>How Kaldan lost</h1>
    <p class=meta>Sign up for the H1 letter and never miss a story.</p><p>The council of Mirlin opened the <b>new</b> bridge&nbsp;after
    the war.</p><div>According to Tormo, the harbour in Vesrik was closed during the winter.<br>Few remember that Kalmo painted the old library of Mirdan in spring.<br><br>More than 40 people have visited the museum of Tordan since 1990.</div>
    <div class=comment><b>kal_mo</b> <p>The council of Vesmo opened the new bridge after the war.</p><a href=#r>Reply</a></div><p>Kal Mo lives in Torlin and has written for H1 since 2002; The council of Vesmo opened the new bridge after the war.</p></body></html>"""
    pages = clash(spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>Home"), (None, page), (5, "<" * 50_000), (6, "<p>" + EN[0] * 5000)], "html_id bigint, html string"))
    blocks = main_body.main_bodies(pages, docs(spark, news))
    got = [r["block"] for r in blocks.where("rec_kind = 'html' and rec_id = 1").orderBy("block_no").collect()]
    assert got == ["The council of Mirlin opened the new bridge after the war.", "According to Tormo, the harbour in Vesrik was closed during the winter. Few remember that Kalmo painted the old library of Mirdan in spring.", "More than 40 people have visited the museum of Tordan since 1990."]
    own = {}
    for r in blocks.where("rec_kind = 'document'").collect():
        own.setdefault(r["rec_id"], []).append((r["block_no"], r["block"]))
    for i, *_, paras in news:
        prose = i % 20 not in (3, 7)
        assert sorted(own.get(i, [])) == ([(n + 1, " ".join(p)) for n, p in enumerate(paras[1:-1])] if prose else [])
    assert main_body.main_bodies(pages.where("false"), docs(spark, [])).count() == 0


def test_stretches():
    assert main_body.stretches(np.array([0, 50, 0, 50, 0, 0, 0, 0, 0, 0, 70.0]), 5) == [(1, 4), (10, 11)]
    assert main_body.stretches(np.zeros(0)) == []
    assert main_body.stretches(np.array([0, 9, 0, 0, 0, 0, 0, 0.0])) == []  # no surge
    assert main_body.stretches(np.array([9, 9, 9.0])) == [(0, 3)]  # together one
    assert main_body.stretches(np.array([40, 0, 40.0]), breaks=np.array([False, True, False])) == [(0, 1), (2, 3)]
    assert list(main_body.keep_body(np.array([30.0, 0, 0, 0, 0, 0, 90.0]), whole=False, window=3)) == [False] * 6 + [True]


def test_surge_and_dive_decide_documents(spark):
    model = line_model.LinearModel(np.zeros((line_model.SLOTS, 6), np.float32), np.array([3, 0, -9, -9, -9, -9], np.float32))
    for word, weight in [("notice", 60), ("perhaps", 13)]:  # surely furniture; furniture, but not surely
        model.weights[line_model.ngram_slots([[word]], {})[0][0], line_model.FURNITURE] = weight
    long, short = "the old bridge was opened again after the long war in the north", "so it was"
    lines = ["a notice", long, "it perhaps closed", "one notice", long, *["some notice"] * 6, short, *["some notice"] * 6, "so perhaps not"]
    classes, sure, prose = line_model.LineClassifier(model).judge(lines)
    assert [c == line_model.PROSE for c in classes] == [x in (long, short) for x in lines]
    assert sure[0] > line_model.SURE > sure[2] and prose[1] > line_model.SURE
    rows = [(1, "example,h)/1", "T", "en", "", [[x] for x in lines]), (2, "example,h)/2", "T", "en", "", [["so perhaps not"], []]), (3, "example,h)/3", "T", "en", "", [[long], [short]])]
    own = sorted((r["doc_id"], r["block_no"]) for r in main_body.document_bodies(docs(spark, rows), model).collect())
    # the doubted line between surge and dive stays; the short prose far from the text doesn't, beside it does
    assert own == [(1, 1), (1, 2), (1, 4), (3, 0), (3, 1)]
    pages = spark.createDataFrame([(1, "".join(f"<p>{x}</p>" for x in lines)), (2, "<p>so perhaps not"), (3, f"<p>{long}<p><a href=/>{long}</a><p>{short}")], "html_id bigint, html string")
    assert sorted((r["html_id"], r["block_no"]) for r in main_body.page_bodies(pages, model).collect()) == [(1, 1), (1, 2), (1, 4), (3, 0)]


def test_markup_is_stripped_in_one_pass():
    assert main_body.visible("a<script>x</script>b<!-- c -->d<h1>e</h1>f<![CDATA[g]]>h") == "abd<p>f<p>h"
    assert main_body.visible("a<button>b<button>c") == "a<button>b<button>c" and main_body.visible("a<!-- b <p>c") == "a"
    began = time.time()
    main_body.page_lines("<button>" * 200_000 + "<select" * 100_000 + "<!" * 100_000)
    assert time.time() - began < 20


def test_planted_residue_on_unseen_hosts(spark, news):
    """Trained on some hosts, the models find what was planted on others, in words that were no label."""
    known = [r for r in news if int(r[1].split(")")[0].split(",h")[1]) < 8]
    judge = junk.train_judge(line_model.sample_lines(docs(spark, known)), docs(spark, known))
    body = [[EN[0], EN[1]], [EN[2]]]
    planted = [
        (1, "example,x)/1", "How Mirlin lost the bridge", "en", "", [["Dear {{reader_name}}, welcome back."], *body]), (2, "example,y)/2", "502 Bad Gateway", "en", "", []), (3, "example,z)/3", "Page not found", "en", "", [["Home / News / Sport / Contact"]]),
        (4, "example,x)/4", "How Tormo lost", "en", "", [["Consectetur adipiscing elit sed do eiusmod tempor."]]), (5, "example,y)/5", "Notes", "en", "", [["The document requested could not be found on this server at all."]]), (6, "example,z)/6", "{{title}}", "en", "", body),
    ]
    fine = [
        (11, "example,x)/11", "How Mirlin lost the bridge", "en", "", body), (12, "example,y)/12", "How Kaldan left the bridge", "en", "", []), (13, "example,z)/13", "How Kaldan left the bridge", "en", "", [["Home / News / Sport / Contact"]]),
        (14, "example,x)/14", "The museum", "en", "", [*body, ["Editors were told to write {{name}} for the reader, Mirlin said."]]),
    ]
    got = {r["doc_id"]: r["residue"] for r in junk.judge_documents(docs(spark, planted + fine), judge).collect()}
    assert got == {r[0]: r[0] < 10 for r in planted + fine}


# ---------------------------------------------------------------- languages


def test_languages_on_held_out_sentences(spark):
    random.seed(10)
    words = {
        "en": "the of and to in was that for with on by at from have which this said after before".split(), "de": "der die das und den von zu mit sich auf ist nicht eine als auch nach wurde".split(),
        "fr": "le la les des et un une du dans qui que est pour sur par avec cette après".split(), "es": "el los las de y en que una por con del para se más como después".split(),
        "pt": "o os as e em que um uma por com do da para não ao foi mais depois".split(), "nl": "de het een en van is dat op te zijn met voor niet aan er ook".split(),
    }
    say = lambda c: " ".join(random.choice(words[c]) if random.random() < 0.7 else random.choice(["Kaldan", "Mirlin", "museum", "hotel"]) for _ in range(14)).capitalize() + "."
    rows, truth = [], {}
    for i in range(900):
        c = random.choice(list(words))
        other = random.choice(list(words)) if i % 10 == 0 else c
        label = random.choice(list(words)) if i % 9 == 0 else random.choice([c, c.upper() + "-XX", language.LABELS[c].split()[2]])
        rows.append((i, f"example,h)/{i}", "t", label, "", [[say(c), say(c)], [say(other)]]))
        truth[i, 0, 0] = truth[i, 0, 1] = c
        truth[i, 1, 0] = other
    got = {(r["doc_id"], r["para_no"], r["sent_no"]): r for r in language.identify(docs(spark, rows + [(5000, None, None, None, None, None), (5001, None, None, "und", "", [[None, "", "123 456"], None])])).collect()}
    assert set(got) == set(truth) | {(5001, 0, 1), (5001, 0, 2)}
    assert got[5001, 0, 2]["lang_code"] is None and got[5001, 0, 2]["confidence"] == 0
    right = sum(got[k]["lang_code"] == c for k, c in truth.items())
    assert right >= 0.98 * len(truth)
    sure = [got[k]["confidence"] for k in truth]
    assert abs(np.mean(sure) - right / len(truth)) < 0.05
    assert language.identify(docs(spark, [])).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("en_US",), ("DEU",), ("Portuguese",), ("und",), ("",), (None,), ("it",), ("unknown",), ("Italian",)], "l string")
    assert [r[0] for r in df.select(language.label_code(F.col("l"))).collect()] == ["en", "de", "pt", None, None, None, "it", None, "italian"]


# ---------------------------------------------------------------- packing


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("capacity", [10, 64, 257])
def test_packing_is_as_good_as_best_fit(spark, capacity):
    random.seed(11)
    sizes = [min(int(random.paretovariate(0.8)), 900) for _ in range(1500)] + [0, 0, 0, capacity, capacity * 3]
    counts = spark.createDataFrame([*enumerate(sizes), (0, sizes[0])], "doc_id bigint, n_tokens bigint")
    rows = packing.assign(clash(counts), [capacity]).toPandas()
    pieces = [x for s in sizes for x in [capacity] * (s // capacity) + [s % capacity] * (s % capacity > 0)]
    load = rows.groupby("container_no").n_tokens.sum()
    assert load.max() <= capacity and rows.container_no.notna().all()
    assert rows.groupby("doc_id").n_tokens.sum().to_dict() == dict(enumerate(sizes))
    assert not rows.duplicated(["doc_id", "piece_no"]).any()
    assert rows[rows.doc_id.isin([i for i, s in enumerate(sizes) if s <= capacity])].groupby("doc_id").size().max() == 1
    assert len(load) <= plain_best_fit(pieces, capacity) + 1


def test_joint_packing_wastes_no_more_than_one_capacity(spark):
    random.seed(12)
    histogram = {}
    for _ in range(800):
        s = random.randint(1, 300)
        histogram[s] = histogram.get(s, 0) + 1
    joint = packing.pack_histogram(histogram, [64, 128, 512])
    assert joint.cost <= packing.pack_histogram(histogram, [512]).cost
    assert sum(e * g[0] for g in joint.groups for e in [sum(n for n in g[2].values())]) == 800


def test_packing_of_odd_documents(spark):
    containers = spark.createDataFrame([("small", 16), ("big", 64), ("none", None), ("bad", 0)], "container_kind string, capacity int")
    df = odd_documents(spark)
    rows = packing.assign_each(df, containers).toPandas()
    assert set(rows.container_kind) == {"small", "big"}
    for _, part in rows.groupby("container_kind"):
        assert set(part.doc_id) == {1, 2, 3, 4, 5}
        assert (part.groupby("container_no").n_tokens.sum() <= part.capacity.iloc[0]).all()
    joint = packing.assign_jointly(df, containers).toPandas()
    assert (joint.groupby(["container_no", "capacity"]).n_tokens.sum().reset_index().eval("n_tokens <= capacity")).all()
    assert packing.assign_each(df.where("false"), containers).count() == 0
    assert packing.assign_each(df, containers.where("false")).count() == 0
    assert packing.assign_jointly(df, containers.where("false")).count() == 0
