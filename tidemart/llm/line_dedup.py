"""Line dedup with a log-template tree, in built-in functions only.

A line goes down a tree of fixed depth: by its number of tokens, then by its
leading tokens, where a token with a digit is a variable field. In a leaf that
holds lines of enough documents, a line's pattern keeps the tokens that enough
documents have at their place and has fields for the others. A leaf holds as many
templates as there are patterns that prove to be one:

* at least half of the tokens behind the leading ones are constants,
* and each is in at least half of the leaf's lines, or those that are not are two
  or more and go together: the pattern has two thirds of all lines that have the
  rarest of them. Common words that meet by chance don't, whatever their number.

Another line goes with the template that its pattern becomes when one constant is
taken for a field, such as a variable that often has the same value; with the
smallest digest of those. A line that no template takes is its own, with fields for
digits only. A template that enough documents
share is recurring. Its first line, by document id and place, stays and all others
are dropped.

Texts that are equal throughout count as one document here: whole copies are no
evidence that a line is boilerplate, so groups of copies stay whole for the
operators that look for them.

Counting works on distinct lines with their number of texts, combined before
each shuffle, so a line in a third of all documents is one row per task. Only
lines of leaves that are full enough are ever cut into tokens. The full leaves,
and the places of dropped lines, are broadcast while their checked number is
small, which spares shuffling the texts; beyond that the joins shuffle.

Defined results: lines are what ``\\n`` separates; tokens what single spaces
separate, after tabs and carriage returns became spaces and the ends were
trimmed; lines without tokens are kept. A null text is empty, with one empty
line. Null ids come last; rows that repeat id and text are treated alike. A very
long text, or line, is one row of a task. An empty table gives no rows. Extra
columns come back as they were from ``dedup``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import carried, keyed, lightened, pin, unpacked

MIN_DOCS = 10  # distinct texts that make a leaf, a constant token and a template
LEADING = 2  # tokens that choose the leaf
MIN_CONSTANT = 0.5  # share of constant tokens in a template, behind the leading ones or in a whole line
MIN_SHARE = 0.5  # share of its leaf's lines from which a token needs no company to be a constant
TOGETHER = (2, 3)  # share of the lines with its rarest other constant that a pattern must have
FIELD = "<*>"
LIGHT = 1_000_000  # leaves, or places of dropped lines, that a join may broadcast
VARIABLE = r"\S*[0-9]\S*"


def masked(c: Column) -> Column:
    return F.regexp_replace(c, VARIABLE, FIELD)


def lines_of(rows: DataFrame, leading: int) -> DataFrame:
    """(doc_id, text_id, pos, line, leaf) of every line that has a token."""
    blanks = "\t\r\v\f"
    some = F.contains("text", F.lit(blanks[0]))
    for c in blanks[1:]:
        some = some | F.contains("text", F.lit(c))
    # few texts have other blanks than spaces, and translating goes character by character
    plain = F.when(some, F.translate("text", blanks, " " * len(blanks))).otherwise(F.col("text"))
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_id"), F.posexplode(F.split(plain, "\n")).alias("pos", "raw"))
    tokens = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    return (lines.select("doc_id", "text_id", "pos", F.trim("raw").alias("line")).where("line <> ''")
            .withColumn("leaf", F.xxhash64(tokens, masked(F.substring_index("line", " ", leading)))))


def full_leaves(lines: DataFrame, min_docs: int) -> DataFrame:
    return (lines.select("leaf", "text_id").distinct().groupBy("leaf").agg(F.count("*").alias("texts"))
            .where(F.col("texts") >= min_docs).select("leaf"))


def templates(lines: DataFrame, min_docs: int, leading: int, min_constant: float) -> DataFrame:
    """(leaf, shape, template) of the masked lines that a template takes or that are their own."""
    kinds = (lines.groupBy("leaf", "shape", "text_id").agg(F.first("masked").alias("masked"))
             .groupBy("leaf", "shape").agg(F.first("masked").alias("masked"), F.count("*").alias("texts")))
    # tokens travel with the line's hash, never with the line itself
    tokens = kinds.select("leaf", "shape", "texts", F.posexplode(F.split("masked", " ")).alias("i", "token"))
    total = kinds.groupBy("leaf").agg(F.sum("texts").alias("total"))
    frequent = (tokens.where(F.col("token") != FIELD).groupBy("leaf", "i", "token")
                .agg(F.sum("texts").alias("n")).where(F.col("n") >= min_docs).join(total, "leaf")
                .select("leaf", "i", "token", "n", (F.col("n") < MIN_SHARE * F.col("total")).alias("weak")))
    known = pin(tokens.join(frequent, ["leaf", "i", "token"], "left"), "tokens")
    constant = F.col("n").isNotNull()
    behind = F.col("i") >= leading
    kept = F.when(constant, F.col("token")).otherwise(FIELD)
    pattern = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", kept.alias("token")))), lambda t: t["token"]), " ")
    # of the constants alone, so that taking one away needs no second look at the others
    digest = F.bit_xor(F.when(constant, F.xxhash64("i", "token")))
    shapes = known.groupBy("leaf", "shape").agg(
        F.first("texts").alias("texts"), F.avg((F.col("token") != FIELD).cast("int")).alias("words"),
        F.avg(F.when(behind, constant.cast("int"))).alias("share"),
        F.count_if(behind & F.col("weak")).alias("weak"), F.min(F.when(behind & F.col("weak"), F.col("n"))).alias("rarest"),
        F.coalesce(digest, F.lit(0)).alias("digest"), F.md5(pattern).alias("pattern"))
    together = TOGETHER[1] * F.col("lines") >= TOGETHER[0] * F.col("rarest")
    judged = pin(shapes.join(shapes.groupBy("leaf", "pattern").agg(F.sum("texts").alias("lines")), ["leaf", "pattern"])
                 .withColumn("is_template", F.coalesce(F.col("share") >= min_constant, F.lit(False))
                             & ((F.col("weak") == 0) | ((F.col("weak") > 1) & together))), "shapes")
    found = (judged.where("is_template").groupBy("leaf", "digest").agg(F.min("pattern").alias("given")))
    others = judged.where("not is_template").select("leaf", "shape", "digest")
    less = (known.where(behind & F.col("weak")).join(others, ["leaf", "shape"])
            .select("leaf", "shape", F.col("digest").bitwiseXOR(F.xxhash64("i", "token")).alias("digest")))
    given = less.join(found, ["leaf", "digest"]).groupBy("leaf", "shape").agg(F.min("given").alias("given"))
    alone = (F.col("texts") >= min_docs) & (F.col("words") >= min_constant)
    template = F.when(F.col("is_template"), F.col("pattern")).otherwise(
        F.coalesce("given", F.when(alone, F.col("shape").cast("string"))))
    return (judged.join(given, ["leaf", "shape"], "left").select("leaf", "shape", template.alias("template"))
            .where(F.col("template").isNotNull()))


def dropped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
            leading: int = LEADING, min_constant: float = MIN_CONSTANT) -> DataFrame:
    """(doc_id, text_id, pos): the lines that go."""
    lines = lines_of(keyed(docs, id_col, text_col), leading)
    full = lightened(pin(full_leaves(lines, min_docs), "leaves"), F.lit(1), LIGHT)
    some = pin(lines.join(full, "leaf", "left_semi")
               .withColumn("masked", masked(F.col("line"))).drop("line")
               .withColumn("shape", F.xxhash64("masked")), "lines")
    found = some.drop("masked").join(templates(some, min_docs, leading, min_constant), ["leaf", "shape"])
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_id", "pos")
    recurring = (found.groupBy("leaf", "template", "text_id").agg(F.min(place).alias("place"))
                 .groupBy("leaf", "template").agg(F.count("*").alias("texts"), F.min("place").alias("place"))
                 .where(F.col("texts") >= min_docs).select("leaf", "template", F.col("place").alias("first")))
    return (found.join(recurring, ["leaf", "template"]).where(~place.eqNullSafe(F.col("first")))
            .select("doc_id", "text_id", "pos").distinct())


def without_lines(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text and any others) with ``left``, the text that is left, and ``places``, what went, sorted."""
    gone = (gone.groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_list("pos")).alias("gone_places"))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text"), "gone_places"))
    gone = lightened(pin(gone, "dropped"), F.size("gone_places") + 1, LIGHT)
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id"))
                       & (F.xxhash64("text") == F.col("gone_text")), "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone_places"))
    left = F.when(F.col("gone_places").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*rows.columns, left.alias("left"),
                         F.coalesce("gone_places", F.array().cast("array<int>")).alias("places"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """All rows and columns of ``docs`` with the dropped lines taken out of the text."""
    out = without_lines(carried(docs, id_col, text_col), dropped(docs, id_col, text_col, **parameters))
    return out.select(*unpacked(docs.columns, text_col, F.col("left")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """Per document: n_lines, n_dropped, the dropped lines' places as text, and the digest of what is left."""
    out = without_lines(keyed(docs, id_col, text_col), dropped(docs, id_col, text_col, **parameters))
    return out.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
                      F.size("places").cast("long").alias("n_dropped"),
                      F.array_join(F.col("places").cast("array<string>"), ",").alias("dropped_lines"),
                      F.sha2(F.col("left"), 256).alias("kept_sha256"))
