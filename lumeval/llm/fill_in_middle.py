"""Fill-in-the-middle transformation as a pyarrow.compute pipeline.

A batch of texts is split into its units (a word with the white space before it, or white space at the end of
the text) as a list array; the list is flattened with its parent rows, every unit gets its ordinal in its row, and
the row's two cuts give it the role prefix, middle or suffix.  Units are filtered by role, rebuilt into lists
by row and joined; the pieces are joined with their marks in the order of the row's form.  Nothing is done per row in
Python.

Cuts and forms come from the four numbers of a SHA-256 of the seed and the id, so a row's result depends on its id and
text alone.  The units are found over bytes: white space is ASCII, and no byte of a longer UTF-8 character is.

Defined results: a null text counts as empty and stays plain, as does a text that holds a mark; a null id counts
as the empty string in the hash; repeated rows are transformed row by row, equally; other columns are never read;
an empty table gives no row.  A text is held whole, batches are cut at about BATCH bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches

SEED = 42
#: Share of texts that are transformed, and share of these in the order suffix, prefix, middle, in percent.
RATE, SPM = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: A byte that no UTF-8 text holds ends each unit while a text is split.
END = b"\xff"
BATCH = 4 << 20


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """The first four groups of eight digits of the hash of ``seed:id`` as numbers h1 to h4."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"__h{i + 1}") for i in range(4)]


def split_units(texts: pa.Array) -> pa.ListArray:
    """Units of each text, as binary values."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), UNIT.encode(), rb"\0" + END)
    ended = pc.binary_slice(marked, 0, -1) if len(marked) else marked
    return pc.if_else(pc.equal(pc.binary_length(marked), 0), pa.scalar([], pa.large_list(pa.large_binary())),
                      pc.split_pattern(ended, END).cast(pa.large_list(pa.large_binary())))


def _lists(values: pa.Array, parents: pa.Array, rows: int) -> pa.LargeListArray:
    """Values back in one list per row; ``parents`` is ascending."""
    counts = np.bincount(parents.to_numpy(zero_copy_only=False), minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)


def transform_batch(texts: pa.Array, h1, h2, h3, h4, rate: int = RATE, spm: int = SPM):
    """n, form, prefix_chars, middle_chars and output of one batch of texts without nulls."""
    texts = texts.cast(pa.large_string())
    rows = len(texts)
    units = split_units(texts)
    n = pc.cast(pc.list_value_length(units), pa.int64())
    choices = n.to_numpy() + 1
    first, second = h1.to_numpy() % choices, h2.to_numpy() % choices
    low, high = np.minimum(first, second), np.maximum(first, second)

    flat, parents = pc.list_flatten(units), pc.list_parent_indices(units)
    start = np.cumsum(n.to_numpy()) - n.to_numpy()
    row = parents.to_numpy()
    ordinal = np.arange(len(flat)) - start[row]
    role = pa.array(np.where(ordinal < low[row], 0, np.where(ordinal < high[row], 1, 2)), pa.int8())
    pieces = []
    for r in range(3):
        chosen = pc.equal(role, r)
        lists = _lists(pc.filter(flat, chosen), pc.filter(parents, chosen), rows)
        pieces.append(pc.cast(pc.binary_join(lists, pa.scalar(b"", pa.large_binary())), pa.large_string()))
    prefix, middle, suffix = pieces

    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(pa.array(h3.to_numpy() % 100), rate))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    back = pc.less(pa.array(h4.to_numpy() % 100), spm)
    form = pc.if_else(plain, "plain", pc.if_else(back, "spm", "psm"))
    p, s, m, nothing = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    output = pc.if_else(plain, texts, pc.if_else(back, spm_text, psm_text))
    none = pa.scalar(None, pa.int64())
    return (n, form, pc.if_else(plain, none, pc.cast(pc.utf8_length(prefix), pa.int64())),
            pc.if_else(plain, none, pc.cast(pc.utf8_length(middle), pa.int64())), output)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ("doc_id",),
              seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``keep`` columns, n, form, prefix_chars, middle_chars and output (the transformed text) of every row."""
    inner = [f"__k{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)],
                      F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *draws(id_col, seed))
    schema = (src.select(*inner).schema.add("n", "long").add("form", "string").add("prefix_chars", "long")
              .add("middle_chars", "long").add("output", "string"))

    def run(it):
        for batch in batches(it, "__text", BATCH):
            def column(name):
                return batch.column(batch.schema.get_field_index(name))
            n, form, p, m, output = transform_batch(column("__text"), *[column(f"__h{i}") for i in range(1, 5)], rate, spm)
            kind = pa.string() if output.nbytes < 1 << 30 else pa.large_string()
            yield pa.RecordBatch.from_arrays([*map(column, inner), n, form, p, m, output.cast(kind)], names=schema.names)

    return src.mapInArrow(run, schema).toDF(*keep, *schema.names[len(inner):])


def _cut(output: Column, first: str, second: str) -> tuple[Column, Column, Column]:
    """The three parts of an output: up to ``first``, up to ``second``, the rest.

    A text with a mark stays plain, so the first mark met is the one that was written.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    one = F.substring_index(body, first, 1)
    rest = F.substr(body, F.char_length(one) + F.lit(len(first) + 1))
    two = F.substring_index(rest, second, 1)
    return one, two, F.substr(rest, F.char_length(two) + F.lit(len(second) + 1))


def restore(output: str, form: str) -> Column:
    """The text before the transformation, rebuilt from the columns ``output`` and ``form`` alone."""
    text, form = F.col(output), F.col(form)
    prefix, suffix, middle = _cut(text, SUFFIX, MIDDLE)
    suffix2, prefix2, middle2 = _cut(text, PREFIX, MIDDLE)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(text))


#: DuckDB SQL of the query's rows.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '{UNIT}') AS u,
             sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d),
k AS (SELECT doc_id, text, u, len(u) AS n, list_transform([1, 9, 17, 25],
        lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS r FROM u),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS hi,
        CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                  OR r[3] % 100 >= {RATE} THEN 'plain'
             WHEN r[4] % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:lo], '') AS prefix,
        array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
              ELSE '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
