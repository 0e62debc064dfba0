"""Line dedup by winnowing, with DataFrame functions only.

A line is cut again after the end of a sentence, so that a passage set into a longer line counts as lines of
its own. From each line on, the shortest run with ``gram_words`` words is a gram. Among the grams that lie in the
shortest run with ``sure_words`` words, the one with the smallest hash is a fingerprint. The choice depends on nothing
outside that run, so two documents that share a run of ``sure_words`` words are sure to share a fingerprint.

Joining the positions of fingerprints finds the documents that share any. In those, matches are extended both ways, gram by gram: a
line goes if it lies in a gram whose first place (smallest doc_id, then line) is another one. Each place is compared with the
first place of its gram only, never with all others, and first places come from a grouping that aggregates before it shuffles.

With ``tails`` the shortest run with ``gram_words`` words that ends at each line is a gram too (unless it is one already), so that the last lines of
a passage inside a longer text go as the first ones do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import stored

GRAM_WORDS = 20
SURE_WORDS = 40
# after a line break, or after a sentence's end and a space
ENDS = [". ", "! ", "? ", "\n"]
CUT = r"(?<=[.!?] )|(?<=\n)"
MARK = "\x01"
BLANKS = " \t\n"


def _with_version(docs: DataFrame) -> DataFrame:
    """The rows with a hash of the text, as an id may come with two texts."""
    return docs.withColumn("_version", F.xxhash64(F.col("text").cast("string")))


def _marked() -> Column:
    """The text with a mark after each of ``ENDS``."""
    marked = F.col("text").cast("string")
    for end in ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    return marked


def _pieces() -> Column:
    """The text cut after each of ``ENDS``. Marks are put in and split at, which is much faster than the pattern; a text that holds the mark takes the pattern."""
    text = F.col("text").cast("string")
    return F.when(F.contains(text, F.lit(MARK)), F.split(text, CUT, -1)).otherwise(F.split(_marked(), MARK, -1))


def _n_pieces() -> Column:
    """How many pieces there are, without making them."""
    text = F.col("text").cast("string")
    return F.when(F.contains(text, F.lit(MARK)), F.size(_pieces())).otherwise(F.octet_length(_marked()) - F.octet_length(text) + 1)


def _lines(docs: DataFrame) -> DataFrame:
    """id, version, words and hashes of the lines that are not blank, without outer space; total (all words), repeats (whether a line comes twice)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).where("id IS NOT NULL AND length(text) > 0")
    # (an array that a lambda reads must be named twice, or the optimizer moves its making into the lambda)
    trimmed = F.transform(_pieces(), lambda p: F.btrim(p, F.lit(BLANKS)))
    lines = _with_version(texts).withColumn("_lines", F.filter(trimmed, lambda x: x != ""))
    words = F.expr("transform(_lines, x -> octet_length(x) - octet_length(replace(x, ' ', '')) + 1)")
    lines = lines.select("id", F.col("_version").alias("version"), words.alias("words"), F.transform("_lines", lambda x: F.xxhash64(x)).alias("hashes"))
    total = F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + w)
    return lines.withColumns({"total": total, "repeats": F.size(F.array_distinct("hashes")) < F.size("hashes")})


def _with_grams(lines: DataFrame, gram_words: int, tails: bool) -> DataFrame:
    """A row for each line: id, version, place (from 0), before (the words before it), gram, last, tail, first; other columns of ``lines``.

    gram is the hash of the shortest run of lines with ``gram_words`` words from the line on, last that run's last line; tail the hash of the one up to the line, if no gram from
    its first line on ends there, first that run's first line.

    A run with a number of words is a range of the words before a line. Windows are within one text, by which the arrays of its lines are dealt: lines are not shuffled once more.
    """
    whole = lines.dropDuplicates(["id", "version"])
    rows = whole.select(*[c for c in lines.columns if c not in ("words", "hashes")], F.posexplode(F.arrays_zip("words", "hashes")).alias("place", "_line"))
    # (columns that cannot be missing are cheaper in windows)
    rows = rows.withColumns({"words": F.coalesce(F.col("_line.words").cast("bigint"), F.lit(0)), "line": F.coalesce("_line.hashes", F.lit(0))}).drop("_line")
    text = Window.partitionBy("id", "version")
    upto = F.coalesce(F.sum("words").over(text.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    rows = rows.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words")).drop("words")
    onward, back = text.orderBy("before"), text.orderBy("upto")
    rows = rows.withColumn("_run", F.collect_list("line").over(back.rangeBetween(1 - gram_words, 0)))
    rows = rows.withColumn("first", F.col("place") - F.size("_run") + 1)
    # where the line before has such a run from the same line on, the gram from there ends earlier
    further = (F.col("before") >= gram_words) & (F.lag("first").over(back) == F.col("first"))
    if not tails:  # only from the last place with a gram to the text's end
        further &= F.col("upto") == F.col("total")
    rows = rows.withColumn("_further", further).withColumn("tail", F.when(F.col("_further"), F.xxhash64("_run"))).drop("_run", "_further", "upto")
    rows = rows.withColumn("_run", F.collect_list("line").over(onward.rangeBetween(0, gram_words - 1)))
    return rows.withColumn("gram", F.when(F.col("total") - F.col("before") >= gram_words, F.xxhash64("_run"))).withColumn("last", F.col("place") + F.size("_run") - 1).drop("_run", "line")


def fingerprints(lines: DataFrame, gram_words: int, sure_words: int, tails: bool = False) -> DataFrame:
    """id, hash: of each run with ``sure_words`` words the smallest gram that begins and ends in it, of a shorter text the smallest of all."""
    rows = _with_grams(lines.select("id", "version", "words", "hashes", "total").repartition("id", "version"), gram_words, tails)
    onward = Window.partitionBy("id", "version").orderBy("before")
    sure = onward.rangeBetween(0, sure_words - 1)
    # (a shorter text is within the sure run from its first line on)
    short = F.col("total") < sure_words
    rows = rows.withColumns({"_begun": F.collect_list(F.when(short, F.least("gram", "tail")).otherwise(F.col("gram"))).over(sure), "_until": F.max("first").over(sure)})
    # the last gram that ends in the run begins where the shortest run up to its last line does
    inside = F.array_min(F.slice("_begun", F.lit(1), F.col("_until") - F.col("place") + 1))
    least = F.when(F.col("place") == 0, F.array_min("_begun"))
    rows = rows.withColumn("hash", F.when(short, least).when(F.col("total") - F.col("before") >= sure_words, inside))
    # (neighbours mostly choose the same)
    rows = rows.select("id", "hash", (~F.col("hash").eqNullSafe(F.lag("hash").over(onward))).alias("_new"))
    return rows.where("hash IS NOT NULL AND _new").select("id", "hash")


def grams(lines: DataFrame, gram_words: int, tails: bool = False) -> DataFrame:
    """A row for each gram: id, version, shared, a and b (its first and last line, from 0), hash, again (whether the document had the gram before)."""
    rows = _with_grams(lines, gram_words, tails)
    made = F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(hash_).alias("hash")) for a, b, hash_ in (("place", "last", "gram"), ("first", "place", "tail"))])
    rows = rows.select("id", "version", "shared", "repeats", F.inline(made)).where("hash IS NOT NULL")
    # (where no line comes twice there is nothing to sort)
    own, order = (F.when(F.col("repeats"), F.col(c)) for c in ("hash", "b"))
    place = F.row_number().over(Window.partitionBy("id", "version", own).orderBy(order))
    return rows.withColumn("again", F.col("repeats") & (place > 1)).drop("repeats")


def repeated_places(docs: DataFrame, gram_words: int = GRAM_WORDS, sure_words: int = SURE_WORDS, tails: bool = False) -> DataFrame:
    """id, version, places (a and b: first and last line that is not blank, from 0) of the grams that an earlier place has, for the documents that have any."""
    # (a shorter text has no gram)
    lines = stored(_lines(docs), "lines").where(F.col("total") >= gram_words)
    prints = stored(fingerprints(lines, gram_words, sure_words, tails), "fingerprints")
    touched = prints.join(_first_ids(prints).select("hash"), "hash").select("id").distinct().withColumn("shared", F.lit(True))
    wanted = lines.join(touched, "id", "left").withColumn("shared", F.coalesce("shared", F.lit(False))).where("shared OR repeats")
    own = stored(grams(wanted, gram_words, tails), "grams")
    shared = own.where("shared")
    later = shared.join(_first_ids(shared), "hash").where("id > first").select("id", "version", "a", "b")
    later = later.union(own.where("again").select("id", "version", "a", "b"))
    return later.groupBy("id", "version").agg(F.collect_list(F.struct("a", "b")).alias("places"))


def _first_ids(grams: DataFrame) -> DataFrame:
    """(hash, first) of the hashes that more than one document has."""
    ids = grams.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    return ids.where("first < last").select("hash", "first")


def without_repeated_lines(docs: DataFrame, gram_words: int = GRAM_WORDS, sure_words: int = SURE_WORDS, tails: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text), text without later repeated runs of lines, with n_lines and removed (places from 0).

    Lines end after line breaks and after a sentence's end (. ! ?) and a space; they are compared without outer spaces, tabs and
    breaks. Blank ones have no words, are in no gram and go with the lines around them. Words of a line: its spaces plus one. A gram (``gram_words`` words) that an earlier place has goes if the document shares
    a fingerprint with another one, which is sure for a common run of ``sure_words`` words, or has the gram twice itself. Without ``tails``,
    up to ``gram_words`` - 1 words at the end of a repeated passage inside a longer text stay.
    Earlier: smaller doc_id, then smaller place, so the first one stays. Other texts stay as
    they are, to the byte. A missing text stays missing, an empty one empty (n_lines 0). Rows that share a doc_id are no
    repeats of each other. Rows without doc_id lose nothing and are no source. Columns named n_lines or
    removed are replaced; other columns stay.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "removed", "text")]
    keyed = _with_version(docs.select(*names, "text")).withColumn("_id", F.col("doc_id").cast("bigint"))
    places = repeated_places(docs.select("doc_id", "text"), gram_words, sure_words, tails)
    places = places.select(F.col("id").alias("_id"), F.col("version").alias("_version"), F.col("places").alias("_places"))
    joined = keyed.join(places, ["_id", "_version"], "left")
    text, gone = F.col("text").cast("string"), F.col("_places").isNotNull()
    # (an array that a lambda reads must be named twice, or the optimizer moves its making into the lambda)
    cut = joined.withColumn("_pieces", F.when(gone, _pieces()))
    filled = F.filter(F.transform("_pieces", lambda p, k: F.when(F.btrim(p, F.lit(BLANKS)) != "", k)), lambda k: k.isNotNull())
    # (blank pieces between the lines of a run go with it)
    ranges = "sort_array(array_distinct(flatten(transform(_places, x -> sequence(_at[x.a], _at[x.b])))))"
    cut = cut.withColumn("_at", filled).withColumn("removed", F.expr(f"if(_places IS NULL, cast(array() AS array<int>), {ranges})"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(_pieces) - 1), removed), i -> _pieces[i]), '')")
    # (out of an array of one: a filter on these columns then stays above their making)
    made = F.struct(
        F.when(gone, kept).otherwise(text).alias("text"),
        F.when(gone, F.size("_pieces")).when(F.length(text) > 0, _n_pieces()).otherwise(0).cast("bigint").alias("n_lines"),
        "removed",
    )
    return cut.select(*names, F.explode(F.array(made)).alias("_made")).select(*names, "_made.*")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeated_lines(docs, tails=True).select(
        "doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), "removed", F.sha2("text", 256).alias("text_sha256")
    )
