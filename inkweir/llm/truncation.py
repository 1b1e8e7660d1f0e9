"""Texts cut off by field limits or broken transfers.

Word trigrams are counted over all texts, at places where a sentence goes on and where it ends. The
final trigram of a text is joined with those counts: one that is frequent inside sentences and almost
never ends one betrays a cut. As a cut may fall inside a word, the last word of a text is also asked as
the beginning of one: trigrams that complete it are frequent, while it never stands there itself. Words
are taken as classes (digits as 0, capitalised words inside a sentence as a name) so that
trigrams with names are frequent enough; where too few trigrams are known, the last two words are asked
in the same way, and then the last word. What is unknown to all three is no cut.

Blocks that end without a full stop by their kind (headlines, bylines, menus; learned from the blocks
that are followed by another one, which are whole) are no cuts. Two further signs stand beside the
trigrams and are reported apart: a mark, entity or tag that a cut leaves behind, and many different texts
of one site with exactly one length in characters or bytes, as a field limit gives, which alone shows
where a cut falls on the end of a sentence.

Everything is built-in SQL expressions: no Python runs on rows. Texts are read twice, once for the
counts and once for their own ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.operators.timestamps import site_of
from inkweir.session import stored

NAME = "#"
_ENDS = r"[.?!…][\"»”')\]]*$"
_ELLIPSIS = r"(\.\.\.|…)$"
#: An entity or a tag that was begun, or a mark that software leaves behind a cut.
_BROKEN = r"(&#?\w{0,7}|<[a-zA-Z/][^<>]*)$"
_MARK = r"\S\s*(\[\+[^\]]*\]|\(more\)|\(continued\)|\[read more\]|\[more\]|\s>>)$"
#: Seen at least so often, a trigram, a bigram or a word counts as known; a kind of block likewise.
KNOWN, KNOWN_KIND = 4, 20
#: Share of its places where a known trigram goes on, beyond which it almost never ends a sentence.
GOES_ON = 0.9
#: Levels of context: two words before the last one, one, none.
LEVELS = ("three", "two", "one")


def _tokens(block: Column) -> Column:
    """Word classes of a block; commas, quotes and brackets go, ends stay."""
    digits = F.regexp_replace(block, r"\d+", "0")
    named = F.regexp_replace(digits, r"(?<=[\p{L}\p{N},;:»\"] )[\"«“(]?\p{Lu}[\p{L}\p{N}'’-]*", NAME)
    return F.filter(F.split(F.translate(F.lower(named), ',;:"«»“”()[]', ""), " "), lambda t: t != "")


def _blocks(text: Column) -> Column:
    """The non-blank blocks of a text, between empty lines, each as one line."""
    flat = F.transform(F.split(F.translate(text, "\t \r", "   "), r"\n\s*\n"), lambda b: F.trim(F.translate(b, "\n", " ")))
    return F.filter(flat, lambda b: b != "")


def _bare(token: Column) -> Column:
    return F.rtrim(token, F.lit(".?!…"))


def _contexts(tokens: Column, i: Column) -> tuple[Column, Column]:
    """Hashes of the two words and of the word before place i."""
    at = lambda k: F.coalesce(F.get(tokens, k), F.lit("<s>"))
    return F.xxhash64(at(i - 2), at(i - 1)), F.xxhash64(at(i - 1))


def _heads(tokens: Column) -> tuple[Column, Column]:
    """Hashes of the first two words and of the first word, by which a block has its kind."""
    first = F.coalesce(F.get(tokens, F.lit(0)), F.lit(""))
    return F.xxhash64(F.lit("head"), first, F.coalesce(F.get(tokens, F.lit(1)), F.lit(""))), F.xxhash64(F.lit("head"), first)


def corpus_counts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents(text) to

    - grams(three, two, word, goes_on, ends): for each trigram, by the hashes of the two words and of
      the one word before its last, at how many places its sentence goes on and where it ends. The
      last word of a text, whose end is in question, isn't counted;
    - kinds(three, two, goes_on, ends): for each kind of whole block, by the hashes of its first two
      words and of its first, how many end without a full stop and with one. Blocks that end a text
      are left out.

    Both come from one reading of the texts and one shuffle; counts are combined before it.
    """
    blocks = documents.select(_blocks(F.col("text")).alias("blocks"))
    each = blocks.select(F.explode(F.transform("blocks", lambda b, i: F.struct(b.alias("block"), (i == F.size("blocks") - 1).alias("last")))).alias("b"))
    tokens = each.select("b.last", F.col("b.block").rlike(_ENDS).alias("full"), _tokens(F.col("b.block")).alias("tokens"))
    # each token beside the two before and the one behind it; expressions on these stay in generated code
    start = lambda k: F.concat(F.array(*[F.lit("<s>")] * k), "tokens")
    behind = F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0)))
    placed = tokens.select("last", "full", F.explode(F.arrays_zip(start(2).alias("a"), start(1).alias("b"), F.col("tokens").alias("word"), behind.alias("behind"), F.slice("tokens", 2, 1).alias("second"))).alias("t")).select("last", "full", "t.*").where("word is not null")
    first = (F.col("a") == "<s>") & (F.col("b") == "<s>")
    ends = F.col("behind").isNull() | F.right("word", F.lit(1)).isin(".", "?", "!")
    gram = F.when(F.col("behind").isNotNull() | ~F.col("last"), F.struct(F.xxhash64("a", "b").alias("three"), F.xxhash64("b").alias("two"), _bare(F.col("word")).alias("word"), ends.alias("ends")))
    head_three, head_two = _heads(F.array(F.col("word"), F.col("second")))
    kind = F.when(first & ~F.col("last"), F.struct(head_three.alias("three"), head_two.alias("two"), F.lit(None).cast("string").alias("word"), F.col("full").alias("ends")))
    rows = placed.select(F.explode(F.array_compact(F.array(gram, kind))).alias("g")).select("g.*")
    counted = stored(rows.groupBy("three", "two", "word").agg(F.count_if(~F.col("ends")).alias("goes_on"), F.count_if("ends").alias("ends")))
    return counted.where("word is not null"), counted.where("word is null").drop("word")


def length_limits(texts: DataFrame) -> DataFrame:
    """texts(site, h, chars, bytes), h a hash of the text, to (site, unit, length): lengths at which a
    site's different texts pile up far above the lengths around."""
    sized = texts.select("site", "h", F.explode(F.array(F.struct(F.lit("char").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("byte").alias("unit"), F.col("bytes").alias("length")))).alias("x")).select("site", "h", "x.*").distinct()
    counted = sized.groupBy("site", "unit", "length").agg(F.count("*").alias("n"))
    around = counted.select("site", "unit", "n", F.col("length").alias("at"), F.explode(F.sequence(F.col("length") - 16, F.col("length") + 16)).alias("length")).where("at <> length").groupBy("site", "unit", "length").agg(F.sum("n").alias("near"))
    joined = counted.join(around, ["site", "unit", "length"], "left")
    return joined.where(F.col("n") >= 4 + 6 * F.coalesce("near", F.lit(0)) / 32).select("site", "unit", "length")


def _evidence(finals: DataFrame, grams: DataFrame, level: str) -> DataFrame:
    """finals(context, word) to (context, word, on, end, more): places where the word goes on and where
    it ends after that context, and where a longer word stands that it begins. Only contexts asked for
    are read; the beginnings tried are as long as words asked for in that context."""
    context = F.col(level) if level != "one" else F.lit(0).cast("bigint")
    asked = finals.select(context.alias("context"), "word").distinct()
    lengths = asked.groupBy("context").agg(F.array_sort(F.collect_set(F.length("word"))).alias("lengths"))
    counted = grams.select(context.alias("context"), "word", "goes_on", "ends").groupBy("context", "word").agg(F.sum("goes_on").alias("goes_on"), F.sum("ends").alias("ends"))
    tried = F.filter("lengths", lambda n: n <= F.length("word"))
    parts = counted.join(lengths, "context").select("context", F.explode(tried).alias("n"), "word", "goes_on", "ends")
    whole = F.col("n") == F.length("word")
    begun = parts.groupBy("context", F.left("word", F.col("n")).alias("word")).agg(*(F.coalesce(F.sum(F.when(c, x)), F.lit(0)).alias(name) for c, x, name in ((whole, F.col("goes_on"), "on"), (whole, F.col("ends"), "end"), (~whole, F.col("goes_on") + F.col("ends"), "more"))))
    return asked.join(begun, ["context", "word"]).select(F.col("context").alias(f"c_{level}"), "word", *(F.col(x).alias(f"{x}_{level}") for x in ("on", "end", "more")))


def truncated(documents: DataFrame) -> DataFrame:
    """documents(doc_id, canonical_url, text) to (doc_id, site, reason, by_gram, by_mark, by_limit): the
    documents whose text was cut. reason: gram (the final trigram), else mark (a broken tag or entity, or
    a mark of a cut), else limit (a length at which the site's texts pile up).

    Null, empty and blank texts are never cut. A null or unreadable URL gives a null site, whose texts
    make one group for limits. Repeated rows give one row; an empty table gives none. Whole texts are
    read, of any length; a text of one word is asked like any other.
    """
    told = documents.select("doc_id", site_of(F.col("canonical_url")).alias("site"), "text").where("doc_id is not null and text is not null and text rlike '\\\\S'")
    grams, kinds = corpus_counts(told)
    block = F.try_element_at("blocks", F.lit(-1))
    ellipsis = block.rlike(_ELLIPSIS)
    ends = told.select("doc_id", "site", F.xxhash64("text").alias("h"), F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.rtrim("text").rlike(_BROKEN).alias("broken"), _blocks(F.col("text")).alias("blocks")).where(F.size("blocks") > 0)
    ends = ends.select("doc_id", "site", "h", "chars", "bytes", (F.col("broken") | block.rlike(_MARK)).alias("by_mark"), ellipsis.alias("ellipsis"), (~block.rlike(_ENDS) | ellipsis).alias("open"), _tokens(F.regexp_replace(block, _ELLIPSIS, "")).alias("tokens"))
    (three, two), (head_three, head_two) = _contexts(F.col("tokens"), F.size("tokens") - 1), _heads(F.col("tokens"))
    word = _bare(F.coalesce(F.try_element_at("tokens", F.lit(-1)), F.lit("")))
    ends = stored(ends.select("doc_id", "site", "h", "chars", "bytes", "by_mark", "ellipsis", "open", three.alias("three"), two.alias("two"), word.alias("word"), head_three.alias("head_three"), head_two.alias("head_two")).distinct())

    limits = length_limits(ends.withColumn("site", F.coalesce("site", F.lit(""))))
    at = lambda unit, length: limits.where(F.col("unit") == unit).select(F.col("site").alias("l_site"), F.col("length").alias(length), F.lit(True).alias(f"at_{unit}"))
    finals = ends.where("open and word <> ''").select("three", "two", "word").distinct()
    kind_two = kinds.groupBy(F.col("two").alias("head_two")).agg(F.sum("goes_on").alias("bare_two"), F.sum(F.col("goes_on") + F.col("ends")).alias("n_two"))
    asked = ends.where("open and word <> ''").select("doc_id", "three", "two", "word", "ellipsis", "head_three", "head_two", F.lit(0).cast("bigint").alias("one"))
    asked = asked.join(kinds.groupBy(F.col("three").alias("head_three")).agg(F.sum("goes_on").alias("bare_three"), F.sum(F.col("goes_on") + F.col("ends")).alias("n_three")), "head_three", "left").join(kind_two, "head_two", "left")
    for level in LEVELS:
        found = _evidence(finals, grams, level)
        asked = asked.join(found.withColumnRenamed(f"c_{level}", level), [level, "word"], "left")
    bare = F.when(F.col("n_three") >= KNOWN_KIND, F.col("bare_three") / F.col("n_three")).when(F.col("n_two") >= KNOWN_KIND, F.col("bare_two") / F.col("n_two"))
    n = {(x, level): F.coalesce(F.col(f"{x}_{level}"), F.lit(0)) for x in ("on", "end", "more") for level in LEVELS}
    known = lambda level: F.lit(level == "three") | bare.isNotNull()  # noqa: E731 - of a kind of its own, a block has but its trigram
    goes_on = reduce(
        lambda so_far, level: so_far
        .when(known(level) & (n["on", level] + n["end", level] >= KNOWN), n["on", level] > GOES_ON * (n["on", level] + n["end", level]))
        .when(known(level) & (n["more", level] >= KNOWN) & (n["on", level] + n["end", level] == 0), True),
        LEVELS, F.when(F.lit(False), False),
    )
    by_gram = asked.where(F.coalesce(bare <= 0.5, F.lit(True)) & F.coalesce(goes_on, F.lit(False))).select("doc_id", F.lit(True).alias("by_gram")).distinct()
    joined = ends.withColumn("l_site", F.coalesce("site", F.lit(""))).join(at("char", "chars"), ["l_site", "chars"], "left").join(at("byte", "bytes"), ["l_site", "bytes"], "left").join(by_gram, "doc_id", "left")
    flags = {"by_gram": F.coalesce("by_gram", F.lit(False)), "by_mark": F.col("by_mark"), "by_limit": F.coalesce("at_char", "at_byte", F.lit(False))}
    each = joined.select("doc_id", "site", *(c.alias(k) for k, c in flags.items())).groupBy("doc_id").agg(F.max("site").alias("site"), *(F.bool_or(k).alias(k) for k in flags))
    reason = F.when(F.col("by_gram"), "gram").when(F.col("by_mark"), "mark").when(F.col("by_limit"), "limit")
    return each.withColumn("reason", reason).where("reason is not null").select("doc_id", "site", "reason", *flags)
