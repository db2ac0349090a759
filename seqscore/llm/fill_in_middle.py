"""Fill-in-the-middle by displacement scatter (op 12).

A text is cut into a prefix, a middle and a suffix, which are written in
another order behind marks.  All texts of a batch are moved at once: a scan
over the batch's bytes finds the cuts, a difference array gets the change of
displacement at every segment's first byte, its running sum is every byte's
output shift, and one numpy scatter writes all outputs.  Restoring is the
inverse gather: the marks found in an output give the displacements back.

Work is bounded: a block holds about ``BLOCK_BYTES`` of text (a longer text is
a block of its own) and shifts are made for ``WINDOW`` bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
BLOCK_BYTES = 2_000_000
WINDOW = 1 << 20

# FIXED VALUES: the bytes that separate words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def _raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary array without nulls."""
    values = values.cast(pa.large_binary()) if pa.types.is_binary(values.type) else values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), at


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``BLOCK_BYTES`` bytes."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def _shifts(size: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first position, shift of every position) by windows: the segments begin
    at ``starts`` (ascending, from 0) and are displaced by ``shifts``.

    The difference array holds the change at each segment's start; where
    segments are empty, changes at one position add up to that of the last."""
    change = np.diff(shifts, prepend=0)
    carry = 0
    for at in range(0, size, WINDOW):
        end = min(size, at + WINDOW)
        lo, hi = np.searchsorted(starts, [at, end])
        diff = np.zeros(end - at, np.int64)
        np.add.at(diff, starts[lo:hi] - at, change[lo:hi])
        diff[0] += carry
        shift = np.cumsum(diff)
        carry = int(shift[-1])
        yield at, shift


def _first_marks(data: np.ndarray, offsets: np.ndarray, mark: bytes) -> np.ndarray:
    """Position of the first ``mark`` inside each text, -1 where there is none."""
    found = np.full(len(offsets) - 1, -1, np.int64)
    span = len(data) - len(mark) + 1
    if span <= 0:
        return found
    at = np.flatnonzero(data[:span] == mark[0])
    for i, byte in enumerate(mark[1:], 1):
        at = at[data[at + i] == byte]
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + len(mark) <= offsets[text + 1]
    found[text[inside][::-1]] = at[inside][::-1]
    return found


def _scan(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ends of all words, each text's place in them, its words, its units.  A
    unit is a word with the blanks before it; blanks behind the last word are
    one more."""
    blank = _SPACE[data]
    last = np.zeros(len(data), bool)
    filled = offsets[1:] > offsets[:-1]
    last[offsets[1:][filled] - 1] = True
    ends = np.flatnonzero(~blank & (np.append(blank[1:], True)[:len(data)] | last)) + 1
    place = np.searchsorted(ends, offsets, "right")
    words = np.diff(place)
    tail = np.zeros(len(words), np.int64)
    tail[filled] = blank[offsets[1:][filled] - 1]
    return ends, place[:-1], words, words + tail


def _transform(data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray], rate: int, spm_rate: int,
               marks: tuple[bytes, bytes, bytes]):
    """n, form (0 plain, 1 psm, 2 spm), prefix and middle characters, output
    bytes and offsets of one block."""
    ends, place, words, n = _scan(data, offsets)
    size = np.diff(offsets)
    marked = np.zeros(len(size), bool)
    for m in marks:
        marked |= _first_marks(data, offsets, m) >= 0
    plain = (size == 0) | marked | (draws[2] % 100 >= rate)
    form = np.where(plain, 0, np.where(draws[3] % 100 < spm_rate, 2, 1))

    def cut(units: np.ndarray) -> np.ndarray:
        known = np.append(ends, 0)
        behind = known[np.clip(place + units - 1, 0, len(known) - 1)]
        return np.where(units == 0, offsets[:-1], np.where(units <= words, behind, offsets[1:]))

    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    c1, c2 = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    prefix, middle, suffix = c1 - offsets[:-1], c2 - c1, offsets[1:] - c2
    lp, ls, lm = map(len, marks)
    out = np.concatenate([[0], np.cumsum(size + np.where(plain, 0, lp + ls + lm))])
    base, spm = out[:-1], form == 2
    to_prefix = np.where(spm, base + ls + suffix + lp, base + lp)
    to_suffix = np.where(spm, base + ls, base + lp + prefix + ls)
    to_middle = base + lp + ls + lm + prefix + suffix
    starts = np.stack([offsets[:-1], c1, c2], 1)
    target = np.stack([to_prefix, to_middle, to_suffix], 1)
    whole = plain[:, None]
    shifts = np.where(whole, (base - offsets[:-1])[:, None], target - starts)
    moved = np.zeros(int(out[-1]), np.uint8)
    for at, shift in _shifts(len(data), starts.ravel(), shifts.ravel()):
        part = data[at:at + len(shift)]
        moved[np.arange(at, at + len(part)) + shift] = part
    for mark, to in zip(marks, (to_prefix - lp, to_suffix - ls, to_middle - lm), strict=True):
        moved[to[~plain][:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    chars = np.zeros((2, len(size)), np.int64)
    for d in np.flatnonzero(~plain):
        for row, (a, b) in enumerate(((offsets[d], c1[d]), (c1[d], c2[d]))):
            chars[row, d] = np.count_nonzero((data[a:b] & 0xC0) != 0x80)
    return n, form, chars[0], chars[1], moved, out


def _restore(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, marks: tuple[bytes, bytes, bytes]):
    """Original bytes and offsets of one block of outputs."""
    plain = form == 0
    p, s, m = (_first_marks(data, offsets, x) for x in marks)
    lp, ls, lm = map(len, marks)
    spm = form == 2
    end = offsets[1:]
    lost = ~plain & ((p < 0) | (s < 0) | (m < 0) | (m < p) | (m < s) | ((s < p) != spm))
    if lost.any():
        raise ValueError("an output does not hold the marks of its form in their order")
    prefix = np.where(spm, m, s) - (p + lp)
    suffix = np.where(spm, p, m) - (s + ls)
    middle = end - (m + lm)
    size = np.where(plain, np.diff(offsets), prefix + middle + suffix)
    out = np.concatenate([[0], np.cumsum(size)])
    base = out[:-1]
    zero = np.zeros(len(size), np.int64)
    to = np.stack([base, base + np.where(plain, zero, prefix), base + np.where(plain, zero, prefix + middle)], 1)
    source = np.stack([p + lp, m + lm, s + ls], 1)
    shifts = np.where(plain[:, None], (offsets[:-1] - base)[:, None], source - to)
    text = np.zeros(int(out[-1]), np.uint8)
    for at, shift in _shifts(len(text), to.ravel(), shifts.ravel()):
        text[at:at + len(shift)] = data[np.arange(at, at + len(shift)) + shift]
    return text, out


def _strings(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """One string array of the blocks' bytes and offsets."""
    arrays = []
    for data, offsets in parts:
        if offsets[-1] > np.iinfo(np.int32).max:
            raise ValueError("the outputs of one block pass 2 GiB")
        arrays.append(pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)),
                                                  pa.py_buffer(data)))
    return pa.concat_arrays(arrays) if arrays else pa.array([], pa.string())


FORMS = np.array(["plain", "psm", "spm"])


def fim(text: Column, doc_id: Column, rate: int = 50, spm_rate: int = 80, seed: int = 42,
        marks: tuple[str, str, str] = MARKS) -> Column:
    """Struct ``n, form, prefix_chars, middle_chars, output`` of a text.

    A text has n units: words with the ASCII blanks before them, and blanks
    behind the last word.  The prefix ends after the smaller, the middle after
    the larger of two draws from 0..n; the rest is the suffix.  ``rate`` of 100
    texts are transformed, ``spm_rate`` of 100 of these as mark, suffix, mark,
    prefix, mark, middle (spm), the others prefix, suffix, middle (psm).  The
    draws come from the SHA-256 of ``seed:doc_id``, so every run and every row
    with the same id and text gives the same result; a null id counts as empty.
    A null text counts as empty; empty texts and texts that hold one of the
    marks stay plain, with null ``prefix_chars`` and ``middle_chars``."""
    marked = tuple(m.encode() for m in marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]

    @F.arrow_udf(RESULT)
    def moved(texts: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        data, offsets = _raw(texts)
        h = [x.to_numpy(zero_copy_only=False) for x in (a, b, c, d)]
        cols: list[list] = [[], [], [], []]
        outputs = []
        for lo, hi in _blocks(offsets):
            at = offsets[lo:hi + 1]
            *values, out, ends = _transform(data[at[0]:at[-1]], at - at[0], [x[lo:hi] for x in h], rate, spm_rate,
                                            marked)
            for col, v in zip(cols, values, strict=True):
                col.append(v)
            outputs.append((out, ends))
        n, form, pre, mid = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(FORMS[form].astype(object), pa.string()),
             pa.array(pre, pa.int64(), mask=form == 0), pa.array(mid, pa.int64(), mask=form == 0),
             _strings(outputs)], ["n", "form", "prefix_chars", "middle_chars", "output"])

    return moved(F.coalesce(text, F.lit("")).cast("binary"), *draws)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text behind an output, from the output and its form alone; an
    output that lacks a mark of its form fails the job.  Null counts as empty."""
    marked = tuple(m.encode() for m in marks)

    @F.arrow_udf("string")
    def gathered(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        data, offsets = _raw(outputs)
        kind = forms.to_numpy(zero_copy_only=False)
        parts = []
        for lo, hi in _blocks(offsets):
            at = offsets[lo:hi + 1]
            parts.append(_restore(data[at[0]:at[-1]], at - at[0], kind[lo:hi], marked))
        return _strings(parts)

    kinds = F.when(form == "psm", 1).when(form == "spm", 2).otherwise(0)
    return gathered(F.coalesce(output, F.lit("")).cast("binary"), kinds)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "fim",
                   **options) -> DataFrame:
    """``docs`` with all its columns and a struct column ``name`` of ``fim``
    (see there); every row gets one, repeated rows equal ones.  ``name`` may
    not be a column of ``docs`` already."""
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the input has a column {name} already: choose another name")
    return docs.withColumn(name, fim(F.col(f"`{text_col}`"), F.col(f"`{id_col}`"), **options))
