"""Hebrew to phonetic script, by a word table and by rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.text import clean_ipa, strip
from lexforge.plans.recovery import settle

# Consonants, vowel points and the letters of the traditional variant.
CONSONANTS = {
    "א": "ʔ", "ב": "b", "ג": "ɡ", "ד": "d", "ה": "h", "ו": "v", "ז": "z", "ח": "χ", "ט": "t", "י": "j", "כ": "k", "ך": "χ", "ל": "l", "מ": "m",
    "ם": "m", "נ": "n", "ן": "n", "ס": "s", "ע": "ʔ", "פ": "p", "ף": "f", "צ": "ts", "ץ": "ts", "ק": "k", "ר": "ʁ", "ש": "ʃ", "ת": "t",
}
SEPHARDIC = {"ר": "r", "ח": "ħ", "ע": "ʕ"}
VOWELS = {
    "ַ": "a", "ָ": "a", "ֶ": "e", "ֵ": "e", "ִ": "i", "ֹ": "o", "ֻ": "u", "ְ": "ə",
}
#: Letter and point that are read together.
POINTED = {("ב", "ּ"): "b", ("כ", "ּ"): "k", ("פ", "ּ"): "p", ("ש", "ׂ"): "s"}
VAV = "ו"


def rules(word: Column, variant: str = "modern") -> Column:
    """Letter-by-letter transliteration; null when no letter or vowel point is known.

    Each character's sound depends on itself and its neighbours alone: a pointed letter takes
    its pair's sound (the point by itself has none), and a vav after a letter and before
    anything but a vowel point is o. Only `sephardic` differs from the modern sounds.
    """
    letters = CONSONANTS | (SEPHARDIC if variant == "sephardic" else {})
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    sound = F.create_map(*(F.lit(x) for pair in (letters | VOWELS).items() for x in pair))

    def emit(c: Column, i: Column) -> Column:
        before, after = F.when(i > 0, F.get(chars, i - 1)), F.get(chars, i + 1)
        out = F.element_at(sound, c)
        vav = (c == VAV) & before.isin(*letters) & after.isNotNull() & ~after.isin(*VOWELS)
        out = F.when(F.coalesce(vav, F.lit(False)), F.lit("o")).otherwise(out)
        for (letter, point), value in POINTED.items():
            out = F.when((c == letter) & F.coalesce(after == point, F.lit(False)), F.lit(value)).otherwise(out)
        return F.coalesce(out, F.lit(""))

    return F.nullif(F.array_join(F.transform(chars, emit), ""), F.lit(""))


def build_lookup(entries: DataFrame) -> DataFrame:
    """(word, ipa) of entries with a usable transcription; the last row of a word wins."""
    rows = entries.select("row_idx", "word", clean_ipa(F.col("ipa")).alias("ipa")).where("ipa is not null and coalesce(word, '') != ''")
    return rows.groupBy("word").agg(F.max_by("ipa", "row_idx").alias("ipa"))


def transliterate(
    words: DataFrame, lookup: DataFrame, variant: str = "modern", column: str = "word", fallback_to_rules: bool = True, external: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(column, ipa, method) of the distinct words; ipa is /.../ or null.

    A whole word or phrase is looked up first. A phrase is then read part by part, at
    spaces or else at hyphens, and each part must have a reading, from the table, the
    `external` phonemiser or the rules; the parts are joined as they were split. `method` tells which of
    lookup, external and rules read it (of several: the last of these).
    """
    own = words.select(F.col(column).alias("raw")).where("raw is not null").distinct().withColumn("bare", strip(F.col("raw"))).where("bare != ''")
    table = lookup.select(F.col("word").alias("bare"), F.col("ipa").alias("known"))
    whole = own.join(table, "bare", "left")
    mark = F.when(F.contains(F.col("bare"), F.lit(" ")), " ").when(F.contains(F.col("bare"), F.lit("-")), "-").otherwise("")
    split = F.when(mark == " ", F.split("bare", " ")).when(mark == "-", F.split("bare", "-")).otherwise(F.array("bare"))
    parts = whole.where("known is null").select("raw", mark.alias("mark"), F.posexplode(F.filter(F.transform(split, strip), lambda x: x != "")).alias("at", "part"))
    parts = parts.join(lookup.select(F.col("word").alias("part"), F.col("ipa").alias("known")), "part", "left")
    other = external(F.col("part")) if external else F.lit(None).cast("string")
    ruled = rules(F.col("part"), variant) if fallback_to_rules else F.lit(None).cast("string")
    rank = F.when(F.col("known").isNotNull(), 1).when(other.isNotNull(), 2).otherwise(3)
    parts = parts.withColumn("rank", rank).withColumn("sound", F.coalesce("known", other, ruled))
    read = parts.groupBy("raw", "mark").agg(
        F.array_sort(F.collect_list(F.struct("at", "sound"))).alias("sounds"), F.max("rank").alias("rank"), F.bool_and(F.col("sound").isNotNull()).alias("ok"),
    )
    text = F.array_join(F.transform("sounds", lambda s: s["sound"]), "\x1f")
    read = read.where("ok").select("raw", F.replace(text, F.lit("\x1f"), F.col("mark")).alias("read"), "rank")
    method = F.when(F.col("known").isNotNull(), "lookup").otherwise(F.element_at(F.array(F.lit("lookup"), F.lit("external"), F.lit("rules")), F.col("rank")))
    sound = F.coalesce("known", "read")
    out = whole.join(read, "raw", "left")
    return out.select(F.col("raw").alias(column), F.concat(F.lit("/"), sound, F.lit("/")).alias("ipa"), F.when(sound.isNotNull(), method).alias("method"))


MISSING = ("", "None")


def fill_documents(documents: DataFrame, lookup: DataFrame, variant: str = "modern", skip_existing: bool = True, **options) -> DataFrame:
    """Fill `ipa_hebrew` of the senses; what has one stays when `skip_existing`, and a failure keeps the old value.

    Adds `ipa_total`, `ipa_generated`, `ipa_skipped` and `ipa_failed` for each document. The senses stay where they are: only the distinct
    words of a document, of senses that are to be filled, leave it, and come back as one map of readings, by which the array is rewritten in place. Documents
    of one id share the map; one without senses has counts of 0. The documents are written first, and so are their words: both are read more than once.
    """
    documents = settle(documents, "documents")
    old = lambda s: F.coalesce(~s["ipa_hebrew"].isin(*MISSING), F.lit(False)) & F.lit(skip_existing)
    senses = F.col("entry.senses")
    wanted = F.array_distinct(F.transform(F.filter(senses, lambda s: ~old(s) & s["hebrew"].isNotNull()), lambda s: s["hebrew"]))
    words = settle(documents.select("id", F.explode(wanted).alias("word")).distinct(), "document-words")
    readings = transliterate(words, lookup, variant, **options).where("ipa is not null").select("word", "ipa")
    maps = words.join(readings, "word").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "ipa"))).alias("readings"))
    own = documents.alias("d").join(maps.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")), "left").select("d.*", F.coalesce("m.readings", F.expr("cast(map() as map<string,string>)")).alias("readings"))
    made = lambda s: F.when(~old(s), F.try_element_at(F.col("readings"), s["hebrew"]))
    filled = F.transform(senses, lambda s: s.withField("ipa_hebrew", F.coalesce(made(s), s["ipa_hebrew"])))
    count = lambda test: F.coalesce(F.size(F.filter(senses, test)), F.lit(0)).cast("long")
    return own.select(
        "id", F.when(senses.isNotNull(), F.col("entry").withField("senses", filled)).otherwise(F.col("entry")).alias("entry"), count(lambda s: F.lit(True)).alias("ipa_total"),
        count(lambda s: made(s).isNotNull()).alias("ipa_generated"), count(old).alias("ipa_skipped"), count(lambda s: ~old(s) & made(s).isNull()).alias("ipa_failed"),
    )


def compare_known(known: DataFrame, lookup: DataFrame, variant: str = "modern") -> DataFrame:
    """(word, existing_ipa, generated_ipa, exact_match, similarity, method) for words with a known reading."""
    from lexforge.functions.text import normalize_ipa, overlap

    made = transliterate(known, lookup, variant).withColumnRenamed("ipa", "generated_ipa")
    both = known.select("word", F.col("ipa").alias("existing_ipa")).join(made, "word", "left")
    a, b = normalize_ipa(F.col("generated_ipa")), normalize_ipa(F.col("existing_ipa"))
    return both.select("word", "existing_ipa", "generated_ipa", (a == b).alias("exact_match"), overlap(a, b).alias("similarity"), "method")
