"""Language identification by character trigrams, learnt from labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.session import cut_lineage, spread_by

SHORT_TEXT = 15
DEFAULT_LANGUAGE = "en"
BROADCAST_GRAMS = 200_000  # trigrams that are sent to every task; more are joined by trigram


def normalized(col: Column) -> Column:
    """Lower-cased letters, every other run being one blank, blanks around."""
    letters = F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.trim(letters), F.lit(" "))


def trigrams(col: Column) -> Column:
    """All trigrams of a text, in time linear in its length: matches that do not
    overlap, taken from the first, second and third character on."""
    parts = [F.regexp_extract_all(F.substring(col, start, 2**31 - 1), F.lit("(?s).{3}"), F.lit(0)) for start in (1, 2, 3)]
    return F.concat(*parts)


def _gram_counts(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    cleaned = docs.select(*keys, normalized(F.col(text)).alias("_text"))
    grams = cleaned.select(*keys, F.explode(trigrams(F.col("_text"))).alias("gram"))
    return grams.groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("n"))


def language_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, logp): smoothed log-probabilities of each language's
    trigrams, with gram null for everything unseen."""
    counts = _gram_counts(labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")), ["lang"], "text")
    counts = cut_lineage(counts, "counts")  # used three times
    size = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    smooth = F.col("total") + F.col("kinds") + 1
    seen = counts.join(size, "lang").select("lang", "gram", F.log((F.col("n") + 1) / smooth).alias("logp"))
    unseen = size.select("lang", F.lit(None).cast("string").alias("gram"), F.log(F.lit(1.0) / smooth).alias("logp"))
    return seen.unionByName(unseen)


def detect_language(docs: DataFrame, profiles: DataFrame, key: str, text: str) -> DataFrame:
    """(key, language), one row per key. Texts of up to 15 characters, and texts
    without any trigram known to a profile, count as the default language. Texts
    with the same key are taken together.

    A trigram meets one row of the table, which has its gain over the unseen
    probability for every language. Trigrams are summed up by key where the text is
    read: one pass, and one row per key and task is shuffled."""
    floor = profiles.filter("gram is null").select("lang", F.col("logp").alias("floor"))
    floors = {r["lang"]: r["floor"] for r in floor.orderBy("lang").collect()}  # one row per language
    gains = profiles.filter("gram is not null").join(floor, "lang").groupBy("gram").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", F.col("logp") - F.col("floor")))).alias("gains")  # at most one per language
    )
    gains = gains.select("gram", F.array(*[F.coalesce(F.col("gains")[name], F.lit(0.0)) for name in floors]).alias("gains"))
    table = cut_lineage(gains, "gains")
    length = F.length(F.coalesce(F.col(text), F.lit(""))).alias("_length")
    grams = docs.select(key, length, F.explode_outer(trigrams(normalized(F.col(text)))).alias("gram"))
    if table.count() <= BROADCAST_GRAMS:
        table = F.broadcast(table)
        grams = grams.withColumn("n", F.when(F.col("gram").isNotNull(), 1).otherwise(0))
    else:  # the trigrams are shuffled, once per text
        grams = spread_by(docs.select(key, text), key).select(key, length, F.explode_outer(trigrams(normalized(F.col(text)))).alias("gram"))
        grams = grams.groupBy(key, "gram").agg(F.max("_length").alias("_length"), F.count("gram").alias("n"))
    sums = [F.sum(F.col("n") * F.coalesce(F.col("gains")[i], F.lit(0.0))).alias(f"_gain{i}") for i in range(len(floors))]
    found = grams.join(table, "gram", "left").groupBy(key).agg(F.max("_length").alias("_length"), F.sum("n").alias("_grams"), *sums)
    # a language that knows none of the trigrams has gained nothing, and is no candidate
    scores = [
        F.when(F.col(f"_gain{i}") > 0, F.struct((-F.round(F.col(f"_gain{i}") + F.col("_grams") * limit, 6)).alias("s"), F.lit(name).alias("lang")))
        for i, (name, limit) in enumerate(floors.items())
    ]
    default = F.lit(DEFAULT_LANGUAGE)
    best = F.coalesce(F.array_min(F.array_compact(F.array(*scores)))["lang"], default) if scores else default
    return found.select(key, F.when(F.col("_length") <= SHORT_TEXT, default).otherwise(best).alias("language"))


def filter_language(docs: DataFrame, profiles: DataFrame, key: str, text: str, lang: str = DEFAULT_LANGUAGE) -> DataFrame:
    """Rows of docs detected as the language."""
    detected = detect_language(docs, profiles, key, text).filter(F.col("language") == lang)
    return docs.join(detected.select(key), key, "left_semi")
