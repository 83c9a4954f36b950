"""Versioned prompt templates (A5, F2, B1, B2) and the classifier tail.

Templates live in a ``prompts(name, version, template)`` table.  A reference
``name:version`` or ``name:latest`` resolves by an equi-join on the name;
rendering a template held in a column substitutes one field in a single
pass, so text inserted from a row is never expanded again, and ``{{``/``}}``
in the template become literal braces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Three versions of a prompt that asks for one of the four support categories.
SUPPORT_CLASSIFIER_TEMPLATES = [
    """Which team should answer this request? Choose billing, technical, account or general.

Request: {message}
Team:""",
    """Route the request below to one team.

billing - money: charges, invoices, refunds (as in: the card was debited for a cancelled plan)
technical - the product does not work, or how to use it (as in: exports stop at row 1000)
account - access and profile (as in: the sign-in code never shows up)
general - whatever is left (as in: where is your office)

Request: {message}

Write the team's name and nothing more.""",
    """Requests arrive at a help desk with four teams: billing, technical, account, general.

Request: {message}

First say in a few words what the writer wants. If two teams could help, prefer the one with the
narrower duty. Then close with a line that starts with "Team:" and names the team.
Team:""",
]

PROMPT_NAME = "support_classifier"
PROMPTS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False), T.StructField("version", T.IntegerType(), False),
    T.StructField("template", T.StringType(), False)])


def prompt_table(spark: SparkSession, name: str = PROMPT_NAME,
                 templates: list[str] | None = None) -> DataFrame:
    """The published versions 1..n of a prompt (a catalog table, small by nature)."""
    rows = [(name, i + 1, t) for i, t in enumerate(templates or SUPPORT_CLASSIFIER_TEMPLATES)]
    return spark.createDataFrame(rows, PROMPTS_SCHEMA)


def resolve(prompts: DataFrame, refs: DataFrame, name_col: str = "name",
            version_col: str = "version") -> DataFrame:
    """Attach the template for each (name, version) reference; a null
    version means ``latest`` (highest published version of the name)."""
    latest = prompts.groupBy(F.col("name").alias("_ln")).agg(F.max("version").alias("_latest"))
    r = refs.join(latest, F.col(name_col) == F.col("_ln"), "left")
    r = r.withColumn("resolved_version", F.coalesce(F.col(version_col), F.col("_latest"))) \
        .drop("_ln", "_latest")
    p = prompts.select(F.col("name").alias("_pn"), F.col("version").alias("_pv"), "template")
    return r.join(p, (F.col(name_col) == F.col("_pn")) & (F.col("resolved_version") == F.col("_pv")), "left") \
        .drop("_pn", "_pv")


def render_columns(template: Column, fields: dict[str, Column]) -> Column:
    """``template.format(**fields)`` for a template held in a column.

    The template is cut from the left into doubled braces, fields and text
    between, as ``str.format`` reads it; a null value renders as empty."""
    names = "".join(rf"\{{{f}\}}|" for f in fields)
    tokens = F.regexp_extract_all(template, F.lit(rf"(?s)(\{{\{{|\}}\}}|{names}[^{{}}]+|.)"), F.lit(1))

    def text(t):
        out = F.when(t == "{{", F.lit("{")).when(t == "}}", F.lit("}"))
        for f, value in fields.items():
            out = out.when(t == "{" + f + "}", F.coalesce(value.cast("string"), F.lit("")))
        return out.otherwise(t)

    return F.array_join(F.transform(tokens, text), "")


def render_column(template: Column, field: str, value: Column) -> Column:
    """``template.format(**{field: value})`` for a template held in a column."""
    return render_columns(template, {field: value})
