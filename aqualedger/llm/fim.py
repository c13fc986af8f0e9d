"""Fill-in-middle: texts cut in three at two drawn places and reordered around sentinels.

One full match of ``(unit)*``, with one code point as the unit, keeps every repetition of
its group; ``ends(1)`` has the number of units and the offset behind each, so both cuts are
read off by index."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import whole_text

UNITS = regex.compile(r"(?s:(.))*+")
UNITS_AT_ONCE = 1 << 18  # code points matched at a time, so that a very long text's ends stay small
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def cut_offsets(text: str, draw_a: int, draw_b: int) -> tuple[int, int, int]:
    """(n, first cut, second cut): the number of units and the offsets behind the smaller and the
    larger of draw_a % (n + 1) and draw_b % (n + 1) of them."""
    if len(text) <= UNITS_AT_ONCE:  # the usual case: one match gives all three
        ends = [0, *UNITS.fullmatch(text).ends(1)]
        n = len(ends) - 1
        low, high = sorted((draw_a % (n + 1), draw_b % (n + 1)))
        return n, ends[low], ends[high]
    pieces = range(0, len(text), UNITS_AT_ONCE)
    before = [0]  # units before each piece
    for at in pieces:
        before.append(before[-1] + len(UNITS.fullmatch(text[at : at + UNITS_AT_ONCE]).ends(1)))
    n = before[-1]

    def offset(units: int) -> int:
        if units == 0:
            return 0
        i = bisect_left(before, units) - 1  # the piece with that unit in it
        return pieces[i] + UNITS.fullmatch(text[pieces[i] : pieces[i] + UNITS_AT_ONCE]).ends(1)[units - before[i] - 1]

    low, high = sorted((draw_a % (n + 1), draw_b % (n + 1)))
    return n, offset(low), offset(high)


def _draws(seed: int, id_col: str) -> list[Column]:
    """The first four 8-digit groups of sha256(`seed:id`) as numbers; a null id reads as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n, form, prefix_chars, middle_chars, output).

    ``n`` counts the whole text's code points.  ``form`` is ``plain`` (the output is the text) for
    empty and null texts, texts that hold a sentinel already, and ``plain_percent`` of the
    others; of the rest ``spm_percent`` have the suffix first and all others are ``psm``.  The
    lengths are null where plain.  Draws come from the id alone, so repeated rows give equal
    rows; a null id draws as the empty id.  An empty table gives no rows, and texts of any
    length are cut whole.  Only the id and text columns are read, so other columns may have any name.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, a, b, c, d in zip(pdf["text"], pdf["h1"], pdf["h2"], pdf["h3"], pdf["h4"]):
                n, i, j = cut_offsets(text, a, b) if text else (0, 0, 0)
                if not text or c % 100 >= 100 - plain_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((n, "plain", None, None, text))
                elif d % 100 < spm_percent:
                    rows.append((n, "spm", i, j - i, SUFFIX + text[j:] + PREFIX + text[:i] + MIDDLE + text[i:j]))
                else:
                    rows.append((n, "psm", i, j - i, PREFIX + text[:i] + SUFFIX + text[j:] + MIDDLE + text[i:j]))
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            out["prefix_chars"], out["middle_chars"] = out["prefix_chars"].astype("Int64"), out["middle_chars"].astype("Int64")
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), whole_text(text_col).cast("string").alias("text"), *_draws(seed, id_col))
    cut = src.mapInPandas(run, "doc_id string, n long, form string, prefix_chars long, middle_chars long, output string")
    return cut.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text behind an output of ``fill_in_middle``: no sentinel stands in a prefix, middle
    or suffix, nor can one arise where they meet, as none of its ends begins another."""

    def between(left: str, right: str | None) -> Column:
        head = F.substring_index(output, right, 1) if right else F.col(output)
        return F.substring_index(head, left, -1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
