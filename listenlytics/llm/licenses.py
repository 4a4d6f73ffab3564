"""License notices by diagonal voting over word pairs.

All rolling pairs of words of a text are joined to the places of the same pairs in license
templates. A pair at word p that stands at place t of a template votes for the diagonal
p - t; an intact template puts all its votes on one diagonal, inserted or lost words move
the rest to a neighbouring one. Neighbouring diagonals are merged, and a merged run is a
find when enough of the template's pairs are in it and its span is about as long.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = "\x01"  # no word; it stands behind each text, so that texts without a find keep a row
MAX_SHIFT = 2
MIN_SHARE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    needed: str = ""  # a pair that tells it from similar notices

    def pairs(self) -> list[tuple[str, str]]:
        words = self.text.split()
        return list(zip(words, words[1:], strict=False))

    def needed_place(self) -> int:
        """The place of the needed pair, -1 if there is none."""
        return self.pairs().index(tuple(self.needed.split())) if self.needed else -1


# The base phrases, then notices in their usual wording.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", needed="version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", needed="version 2"),
    Template("lgpl", "gnu lesser general public license", needed="gnu lesser"),
    Template("apache-2.0", "licensed under the apache license version 2 0", needed="version 2"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", needed="by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", needed="by sa"),
    Template("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", needed="mozilla public"),
    Template("all-rights-reserved", "all rights reserved"),
)


def _pairs_table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(_first, _second, template, base, place); the row of ``END`` has template -1."""
    rows = [
        (first, second, number, template.base, place)
        for number, template in enumerate(templates)
        for place, (first, second) in enumerate(template.pairs())
    ]
    rows.append((END, END, -1, False, 0))
    return spark.createDataFrame(
        rows, "_first string, _second string, template int, base boolean, place int"
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
) -> DataFrame:
    """Words, base phrases, labels, score and found spans of each text.

    Null texts count as empty. One row for each input row, repeated rows and null ids
    included. ``score`` is the largest share of a template's pairs in one find, 0 without
    finds. ``spans`` lists the finds as label:first word:word behind the last.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, UPPER.lower())
    words = docs.select(
        F.col(id_col).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("_words"),
    )
    nexts = F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0)))
    pairs = F.arrays_zip(
        F.concat("_words", F.array(F.lit(END))).alias("_first"),
        F.concat(nexts, F.when(F.size("_words") > 0, F.array(F.lit(END), F.lit(END))).otherwise(F.array(F.lit(END)))).alias("_second"),
    )
    rolled = words.select("_id", "_row", F.posexplode(pairs).alias("_place", "_pair")).select(
        "_id", "_row", "_place", F.col("_pair._first").alias("_first"), F.col("_pair._second").alias("_second")
    )
    # the templates are a fixed list, so their pairs can be broadcast
    votes = rolled.join(F.broadcast(_pairs_table(spark, templates)), ["_first", "_second"])

    diagonals = votes.groupBy("_id", "_row", "template", "base", (F.col("_place") - F.col("place")).alias("_diagonal")).agg(
        F.collect_set("place").alias("_places"), F.min("_place").alias("_from"), F.max("_place").alias("_to")
    )
    in_order = Window.partitionBy("_id", "_row", "template").orderBy("_diagonal")
    before = F.lag("_diagonal").over(in_order)
    fresh = F.when(F.col("base") | before.isNull() | (F.col("_diagonal") - before > MAX_SHIFT), 1).otherwise(0)
    runs = (
        diagonals.withColumn("_fresh", fresh)
        .withColumn("_run", F.sum("_fresh").over(in_order))
        .groupBy("_id", "_row", "template", "base", "_run")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("_places"))).alias("_places"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
        )
        .withColumn("_hits", F.size("_places"))
    )
    sizes = F.array(*[F.lit(len(t.pairs())) for t in templates])
    labels = F.array(*[F.lit(t.label) for t in templates])
    needed = F.array(*[F.lit(t.needed_place()) for t in templates])[F.col("template")]
    size, end = sizes[F.col("template")], F.col("template") == -1
    verified = F.when(F.col("base"), F.col("_hits") == size).otherwise(
        (F.col("_hits") >= MIN_SHARE * size)
        & (F.col("_to") - F.col("_from") < 2 * size)
        & ((needed < 0) | F.array_contains("_places", needed))
    )
    finds = runs.where(end | verified).withColumns(
        {
            "_label": F.when(~end, labels[F.col("template")]),
            "_share": F.when(~end, F.col("_hits") / size),
        }
    )
    is_base, place = F.col("base"), F.col("_from").cast("bigint")
    span = F.concat_ws(":", "_label", F.col("_from").cast("string"), (F.col("_to") + 2).cast("string"))

    def listed(condition) -> F.Column:
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(condition, F.col("_label")))))

    return (
        finds.groupBy("_id", "_row")
        .agg(
            F.max(F.when(F.col("template") == -1, place)).alias("n_words"),
            F.count_if(is_base).cast("bigint").alias("n_base"),
            F.min(F.when(is_base, place)).alias("first_word"),
            F.max(F.when(is_base, place)).alias("last_word"),
            listed(is_base).alias("base_labels"),
            listed(F.lit(True)).alias("labels"),
            F.coalesce(F.max("_share"), F.lit(0.0)).alias("score"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("template") >= 0, span)))).alias("spans"),
        )
        .drop("_row")
        .withColumnRenamed("_id", id_col)
    )


def _template_sql() -> str:
    rows = [
        f"('{a}', '{b}', {number}, {str(t.base).lower()}, {place}, {len(t.pairs())}, {t.needed_place()}, '{t.label}')"
        for number, t in enumerate(TEMPLATES)
        for place, (a, b) in enumerate(t.pairs())
    ]
    return ",\n    ".join(rows)


SCAN_SQL = rf"""
WITH templates(w0, w1, template, base, place, size, needed, label) AS (VALUES
    {_template_sql()}),
worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
rolled AS (
  SELECT doc_id, unnest(words[:-2]) AS w0, unnest(words[2:]) AS w1, unnest(range(len(words) - 1)) AS spot
  FROM worded WHERE len(words) > 1),
diagonals AS (
  SELECT doc_id, template, base, size, needed, label, spot - place AS diagonal, list(DISTINCT place) AS places,
    min(spot) AS a, max(spot) AS b
  FROM rolled JOIN templates USING (w0, w1) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER w <= {MAX_SHIFT} IS NOT TRUE THEN 1 ELSE 0 END AS fresh
  FROM diagonals WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM marked),
runs AS (
  SELECT doc_id, template, base, size, needed, label, run, list_distinct(flatten(list(places))) AS found,
    min(a) AS a, max(b) AS b
  FROM numbered GROUP BY ALL),
finds AS (
  SELECT *, len(found) AS hits FROM runs
  WHERE CASE WHEN base THEN len(found) = size ELSE len(found) >= {MIN_SHARE} * size AND b - a < 2 * size
    AND (needed < 0 OR list_contains(found, needed)) END)
SELECT doc_id, len(any_value(words)) AS n_words, count(*) FILTER (base) AS n_base,
  min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
  coalesce(max(hits / size), 0) AS score,
  coalesce(string_agg(DISTINCT label || ':' || a || ':' || (b + 2), ',' ORDER BY label || ':' || a || ':' || (b + 2)), '') AS spans
FROM worded LEFT JOIN finds USING (doc_id) GROUP BY doc_id
"""
