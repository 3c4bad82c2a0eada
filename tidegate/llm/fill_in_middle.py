"""Fill-in-the-middle rearrangement of texts, as a pipeline of Arrow kernels over each batch.

A text is cut into units (a word with the white space before it; trailing white space is a unit of its own).
Two unit positions, drawn from a hash of seed and ``doc_id``, cut it into prefix, middle and suffix, which are
put in another order with a marker before each.  Units of a whole batch are handled at once: split into a
list array, flattened with the number of their text, numbered within it, given a role by the two positions,
filtered by role, put in lists again and joined.  No Python code runs for a single text or unit.

Draws depend on seed and ``doc_id`` alone, so reruns agree and equal ids are cut alike.  There is no shuffle.
A batch is cut into runs of at most ``RUN_BYTES`` of text (or one text), so memory is bounded by the longest
text: some ten times its bytes.

NULL and empty texts have no units and stay plain, as do texts that hold a marker.  Rows with one ``doc_id``
and text come out alike, once for each.  A NULL ``doc_id`` is drawn for as the empty string.  An empty table
gives no rows.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RUN_BYTES = 16 << 20
#: A unit that has a word; RE2 syntax.
WORD_UNIT = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
# Units are split at END.  ESCAPE in a text is doubled up with a zero first, so END stands only where it was put.
ESCAPE, ESCAPED, END = "\x01", "\x010", "\x011"

_RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``doc_id``, number of units, form (plain, psm, spm), lengths in code points and the output of every row.

    ``rate`` of 100 texts are rearranged, ``spm_rate`` of 100 of these with the suffix first.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(drawn, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *draws)

    def rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                yield rearrange(run, rate, spm_rate)

    return rows.mapInArrow(rearranged, _RESULT)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, from the output and its form alone."""
    whole = F.col(output)
    body = F.substring(whole, len(PREFIX) + 1, 2**31 - 1)

    def parts(second: str) -> tuple[Column, Column, Column]:
        later = F.split_part(body, F.lit(second), F.lit(2))
        return (
            F.split_part(body, F.lit(second), F.lit(1)),
            F.split_part(later, F.lit(MIDDLE), F.lit(1)),
            F.split_part(later, F.lit(MIDDLE), F.lit(2)),
        )

    prefix, suffix, middle = parts(SUFFIX)
    suffix_first, prefix_second, middle_last = parts(PREFIX)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
        .when(F.col(form) == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(whole)
    )


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``RUN_BYTES`` of text, or of one text that is longer."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + RUN_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def rearrange(batch: pa.RecordBatch, rate: int, spm_rate: int) -> pa.RecordBatch:
    text = batch["text"].cast(pa.large_string())
    units, n = _units(text)
    cuts = [_remainder(batch[h], pc.add(n, 1)) for h in ("h1", "h2")]
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    held = [pc.match_substring(text, mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = pc.or_(pc.or_(held[0], held[1]), pc.or_(held[2], pc.equal(n, 0)))
    plain = pc.or_(plain, pc.greater_equal(_remainder(batch["h3"], 100), rate))
    spm = pc.less(_remainder(batch["h4"], 100), spm_rate)

    parent, value = _flat(units, n)
    place = pc.subtract(pa.array(np.arange(len(value), dtype=np.int64)), pc.take(_starts(n), parent))
    role = pc.add(
        pc.greater_equal(place, pc.take(first, parent)).cast(pa.int8()),
        pc.greater_equal(place, pc.take(second, parent)).cast(pa.int8()),
    )
    lengths = [first, pc.subtract(second, first), pc.subtract(n, second)]
    prefix, middle, suffix = (
        _joined(pc.filter(value, pc.equal(role, i)), length) for i, length in enumerate(lengths)
    )
    empty, p, s, m = (pa.scalar(mark, pa.large_string()) for mark in ("", PREFIX, SUFFIX, MIDDLE))
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, empty)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, empty)
    output = pc.if_else(plain, text, pc.if_else(spm, spm_text, psm_text))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    counts = [pc.if_else(plain, none, pc.utf8_length(part).cast(pa.int64())) for part in (prefix, middle)]
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], n, form.cast(pa.string()), *counts, output.cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def _units(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """A list of units for each text, still escaped and with an empty one last if it ends in a word; their number."""
    marked = pc.replace_substring_regex(
        pc.replace_substring(text, ESCAPE, ESCAPED), pattern=WORD_UNIT, replacement="\\1" + END
    )
    units = pc.split_pattern(marked, END)
    lengths = pc.list_value_length(units).cast(pa.int64())
    at_word = pc.or_(pc.ends_with(marked, END), pc.equal(marked, ""))
    return units, pc.subtract(lengths, at_word.cast(pa.int64()))


def _flat(units: pa.Array, n: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Parent index and value of every unit, the empty ones at the end of lists left out."""
    value = pc.list_flatten(units)
    filled = pc.not_equal(value, "")
    value = pc.replace_substring(pc.filter(value, filled), ESCAPED, ESCAPE)
    return pc.filter(pc.list_parent_indices(units), filled), value


def _starts(lengths: pa.Array) -> pa.Array:
    """Offsets of lists with these lengths, the end of the last one included."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths).cast(pa.int64())])


def _joined(value: pa.Array, lengths: pa.Array) -> pa.Array:
    lists = pa.LargeListArray.from_arrays(_starts(lengths), value)
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def _remainder(value: pa.Array, by) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))
