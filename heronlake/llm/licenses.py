"""License scans by diagonal voting.

Templates are word sequences, a table of whole licence texts and phrases. Every rolling k-gram of a text's words is hashed
and joined to the template positions with the same hash; hits carry their words, so a hash collision cannot vote. A hit at
text place p and template place t votes for the diagonal p - t, and votes are counted for each diagonal.

* A diagonal with all of a template's k-grams is an exact span.
* The other diagonals of a template are sorted, and neighbours at most MERGE apart, which a few inserted or missing words
  set apart, are merged. Of several hits at one place the one whose diagonal has the most votes stays. Merged hits are
  verified in text order: a span goes on while template places rise, the diagonal moves by MERGE at most and the next hit
  is at most GAP words away; it counts when it holds LEAST of the template's k-grams and is not much longer than the template.

Everything after the join is sorting and comparing neighbours, so the work is linear (but for the sort) in a text's hits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heronlake.llm import common
from heronlake.llm.license_texts import WORDINGS

K = 3
#: Diagonals so near to each other belong together.
MERGE = 4
#: Words from one hit of a span to the next.
GAP = 16
#: Share of a template's k-grams that a span must hold.
LEAST = 0.8
#: Words of a span at most, in words of its template.
STRETCH = 1.5
#: Template k-grams up to which their table is broadcast; a larger one is shuffled.
MAX_TEMPLATE_GRAMS = 100_000
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(WORD_GAP, self.text.lower()) if w]


#: Fixed values of the query's contract (base), and wordings of public licences that the method looks for beside them.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    *(Template(label, text) for label, text in WORDINGS),
)


def words_of(text: Column) -> Column:
    """Words of a lower-cased text; null: none. Lower-casing beyond A-Z cannot make or break an ASCII phrase's word."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP), "")


def template_table(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(label, text, base): templates as a table."""
    return spark.createDataFrame([(t.label, t.text, t.base) for t in templates], "label string, text string, base boolean")


def _rolling(words: Column, k: int) -> Column:
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (k - 1), F.lit(0))), lambda w, i: F.concat_ws(" ", w, *(F.get(words, i + j) for j in range(1, k))))


def _template_grams(templates: DataFrame, k: int) -> DataFrame:
    """(tid, label, base, tlen, tpos, tgram, h): the k-grams of a table of templates (label, text, base)."""
    cut = templates.select("label", "base", words_of(F.col("text")).alias("w")).distinct().withColumn("tid", F.xxhash64("label", "base", "w"))
    short = cut.where(F.size("w") < k).first()
    if short is not None:
        raise ValueError(f"a template needs at least {k} words: {' '.join(short['w'])!r}")
    return cut.select("tid", "label", "base", (F.size("w") - k + 1).alias("tlen"), F.posexplode(_rolling(F.col("w"), k)).alias("tpos", "tgram")).withColumn("h", F.xxhash64("tgram"))


def scan(docs: DataFrame, templates: DataFrame | None = None, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of templates (label, text, base; default: TEMPLATES): (doc_id, n_words, copies, spans).

    spans: array of (label, base, first word, last word, exact, coverage) of the verified spans, exact where one diagonal
    holds the whole template. Texts without a hit have an empty array. Equal rows (same id and text) of one input partition
    come as one row with copies > 1, so that a row repeated without end makes no hot key.
    """
    grams = _template_grams(template_table(docs.sparkSession) if templates is None else templates, k)
    grams = common.materialise(grams, "license-templates")
    side = F.broadcast(grams) if grams.count() <= MAX_TEMPLATE_GRAMS else grams
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("t1"), F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("t2"), F.spark_partition_id().alias("part"), words_of(text).alias("words"))
    key = ["doc_id", "t1", "t2", "part"]
    # no array beside the exploded one: each of its rows would copy it
    cut = rows.select(*key, F.size("words").alias("n_words"), _rolling(F.col("words"), k).alias("grams"))
    spread = cut.select(*key, "n_words", F.posexplode_outer("grams").alias("pos", "gram"))
    # hits, and a head row for each document (place 0 or none) that counts its copies
    met = spread.join(side, (F.xxhash64("gram") == F.col("h")) & (F.col("gram") == F.col("tgram")), "left").where("tid is not null or pos is null or pos = 0")
    hits = met.groupBy(*key, "n_words", "tid", "label", "base", "tlen", "pos", "tpos").agg(F.count("*").alias("copies")).repartition(*key)
    lane = [*key, "tid"]
    voted = hits.withColumn("diag", F.col("pos") - F.col("tpos")).withColumn("votes", F.count("*").over(Window.partitionBy(*lane, "diag")))
    voted = voted.withColumn("whole", F.when(F.col("votes") == F.col("tlen"), F.col("diag")))
    lane.append("whole")
    merged = _runs(voted, lane, ["diag", "pos"], F.col("diag") - F.lag("diag").over(Window.partitionBy(*lane).orderBy("diag", "pos")) <= MERGE, "near")
    lane.append("near")
    first = F.row_number().over(Window.partitionBy(*lane, "pos").orderBy(F.desc("votes"), "tpos"))
    one = merged.withColumn("first", first).where("first = 1")
    before = Window.partitionBy(*lane).orderBy("pos")
    goes_on = (F.col("pos") - F.lag("pos").over(before) <= GAP) & (F.col("tpos") > F.lag("tpos").over(before)) & (F.abs(F.col("diag") - F.lag("diag").over(before)) <= MERGE)
    chained = _runs(one, lane, ["pos"], goes_on, "chain")
    head = F.coalesce(F.col("pos") == 0, F.lit(True))
    spans = chained.groupBy(*lane, "chain", "n_words", "label", "base", "tlen").agg(F.count("*").alias("n"), F.min("pos").alias("first"), (F.max("pos") + (k - 1)).alias("last"), F.max(F.when(head, F.col("copies"))).alias("copies"))
    whole = F.col("whole").isNotNull()
    holds = F.col("tid").isNotNull() & (whole | (F.col("n") >= LEAST * F.col("tlen")) & (F.col("last") - F.col("first") + 1 <= STRETCH * (F.col("tlen") + k - 1)))
    span = F.struct("label", "base", "first", "last", whole.alias("exact"), (F.col("n") / F.col("tlen")).alias("coverage"))
    return spans.groupBy(*key, "n_words").agg(F.max("copies").alias("copies"), F.collect_list(F.when(holds, span)).alias("spans")).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "copies", "spans")


def _runs(rows: DataFrame, lane: list[str], order: list[str], goes_on: Column, name: str) -> DataFrame:
    """rows with a number for each run of neighbours (in order, within a lane) of which each goes on from the one before."""
    cut = rows.withColumn("cut", F.when(goes_on, 0).otherwise(1))
    return cut.withColumn(name, F.sum("cut").over(Window.partitionBy(*lane).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("cut")


def label_documents(docs: DataFrame, templates: DataFrame | None = None, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row for each row of docs.

    Null and empty texts: no words, no labels, score 0. Repeated rows come back as often as they came; null ids pass through;
    an empty table gives no rows; other columns are ignored. Overlapping places all count. score: the best coverage of a
    template by a verified span, 1 for an exact one.
    """
    found = scan(docs, templates, k, id_col, text_col)
    hits = F.filter("spans", lambda s: s["exact"] & s["base"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    firsts = F.transform(hits, lambda s: s["first"].cast("long"))
    out = found.select(
        "doc_id", "n_words", F.size(hits).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        joined(hits).alias("base_labels"), joined(F.col("spans")).alias("labels"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"),
    )
    return out.drop("_copy")
