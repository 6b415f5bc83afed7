"""Fill-in-middle form of documents, by rotating the blocks of a byte buffer in place."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
# Of 100 documents, those that are rearranged, and of 100 of them those with the suffix first.
CHANGED, SUFFIX_FIRST = 50, 80
# What stands before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, SUFFIX_PREFIX_MIDDLE, PREFIX_SUFFIX_MIDDLE = "plain", "spm", "psm"

# Bytes scanned, and bytes swapped, at a time; bytes of texts given back at a time.
SCAN, SWAP, BATCH = 1 << 20, 1 << 16, 1 << 23

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _unit_ends(data: np.ndarray, low: int) -> np.ndarray:
    """Where units end within ``SCAN`` bytes from ``low``.

    A unit is white space with what follows it up to the next white space, or white space at the end.
    Both are bytes below 128, so bytes can be looked at in place of code points.
    """
    high = min(low + SCAN, len(data))
    blank = _BLANK[data[low : min(high + 1, len(data))]]
    if high < len(data):
        ends = ~blank[:-1] & blank[1:]
    else:
        ends = ~blank & np.append(blank[1:], True)
        ends[-1] = True
    return np.flatnonzero(ends) + low + 1


def count_units(data: np.ndarray) -> int:
    return sum(len(_unit_ends(data, low)) for low in range(0, len(data), SCAN))


def cut_places(data: np.ndarray, units: Sequence[int]) -> list[int]:
    """The byte behind each of the given numbers of units, which rise."""
    places = [0 if n == 0 else len(data) for n in units]
    seen = 0
    for low in range(0, len(data), SCAN):
        ends = _unit_ends(data, low)
        for k, n in enumerate(units):
            if seen < n <= seen + len(ends):
                places[k] = int(ends[n - seen - 1])
        seen += len(ends)
        if seen >= units[-1]:
            break
    return places


def reverse(data: np.ndarray, low: int, high: int) -> None:
    """Turn ``data[low:high]`` around in place, two short blocks at a time."""
    while high - low > 1:
        size = min(SWAP, (high - low) // 2)
        front = data[low : low + size][::-1].copy()
        data[low : low + size] = data[high - size : high][::-1]
        data[high - size : high] = front
        low, high = low + size, high - size


def rotate(buffer: bytearray, low: int, joint: int, high: int) -> None:
    """Exchange the neighbours ``buffer[low:joint]`` and ``buffer[joint:high]`` in place.

    Each is reversed by itself and then both together, which leaves either in its own order.
    """
    data = np.frombuffer(buffer, np.uint8)
    reverse(data, low, joint)
    reverse(data, joint, high)
    reverse(data, low, high)


def arranged(raw: bytes, first: int, second: int, form: str, marks: Sequence[bytes]) -> bytearray:
    """The text cut behind ``first`` and ``second`` bytes, in the order of ``form``."""
    buffer = bytearray(raw)
    prefix, suffix, middle = marks
    buffer[second:second] = suffix
    buffer[first:first] = middle
    buffer[0:0] = prefix
    middle_at = len(prefix) + first
    suffix_at = middle_at + len(middle) + second - first
    if form == PREFIX_SUFFIX_MIDDLE:
        rotate(buffer, middle_at, suffix_at, len(buffer))
    else:
        rotate(buffer, 0, suffix_at, len(buffer))
    return buffer


def put_back(raw: bytes, form: str, marks: Sequence[bytes]) -> bytes:
    """The text that ``arranged`` was given, from its result and form alone."""
    if form == PLAIN:
        return raw
    prefix, suffix, middle = marks
    buffer = bytearray(raw)
    middle_at = buffer.find(middle)
    if form == PREFIX_SUFFIX_MIDDLE:
        suffix_at = buffer.find(suffix)
        rotate(buffer, suffix_at, middle_at, len(buffer))
        middle_at, suffix_at = suffix_at, suffix_at + len(buffer) - middle_at
    else:
        prefix_at = buffer.find(prefix)
        rotate(buffer, 0, prefix_at, len(buffer))
        middle_at, suffix_at = middle_at - prefix_at, len(buffer) - prefix_at
    del buffer[suffix_at : suffix_at + len(suffix)]
    del buffer[middle_at : middle_at + len(middle)]
    del buffer[: len(prefix)]
    return bytes(buffer)


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def _check(sentinels: Sequence[str]) -> list[bytes]:
    """Sentinels as bytes. None may lie in another or begin as one ends.

    Then the first place where a sentinel is found is where it was put, whatever stands around it.
    """
    marks = [s.encode() for s in sentinels]
    if len(marks) != 3 or not all(marks):
        raise ValueError("three sentinels that are not empty are needed")
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            if any(a.endswith(b[:n]) for n in range(1, len(b) + (i != j))):
                raise ValueError(f"sentinels {sentinels[i]!r} and {sentinels[j]!r} can be mistaken")
            if i != j and b in a:
                raise ValueError(f"sentinel {sentinels[j]!r} lies in {sentinels[i]!r}")
    return marks


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of every document.

    A text has ``n`` units: white space with the word behind it, or white space at the end. Four numbers, from
    the SHA-256 of ``seed:doc_id``, say where the two cuts fall, whether the text is changed (``changed``
    of 100) and whether the suffix comes first (``suffix_first`` of 100 changed ones). ``output`` is the
    text with a sentinel before each of prefix, suffix and middle: prefix, suffix, middle in form ``psm``,
    suffix, prefix, middle in form ``spm``. In form ``plain`` it is the text as it is: empty texts, those that hold a sentinel,
    and those not drawn. ``prefix_chars`` and ``middle_chars`` count code points, null in form ``plain``.

    A text is copied once into a byte buffer, in which its blocks change places; what is held
    beyond that does not grow with its length. Texts without any white space are one unit. Null texts count as
    empty. A null id gives the numbers of an empty one; repeated rows come out alike, an
    empty table gives no rows, other columns are ignored.
    """
    marks = _check(sentinels)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    turns = [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)
    ]

    def changed_form(raw: bytes, h3: int, h4: int) -> str:
        if not raw or h3 % 100 >= changed or any(mark in raw for mark in marks):
            return PLAIN
        return SUFFIX_PREFIX_MIDDLE if h4 % 100 < suffix_first else PREFIX_SUFFIX_MIDDLE

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            schema = schema or pa.schema(
                [
                    ("doc_id", batch.column("doc_id").type), ("n", pa.int64()), ("form", pa.string()),
                    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
                ]
            )
            hashes = [batch.column(f"h{i}").to_pylist() for i in range(1, 5)]
            rows, low, held = [], 0, 0
            for k, raw in enumerate(_texts(batch.column("text"))):
                data = np.frombuffer(raw, np.uint8)
                n = count_units(data)
                h1, h2, h3, h4 = [h[k] for h in hashes]
                form = changed_form(raw, h3, h4)
                if form == PLAIN:
                    rows.append((n, form, None, None, raw))
                else:
                    first, second = cut_places(data, sorted((h1 % (n + 1), h2 % (n + 1))))
                    counts = _characters(data[:first]), _characters(data[first:second])
                    rows.append((n, form, *counts, bytes(arranged(raw, first, second, form, marks))))
                held += len(raw)
                if held >= BATCH or k + 1 == batch.num_rows:
                    ids = batch.column("doc_id").slice(low, len(rows))
                    yield _batch(ids, rows, schema)
                    rows, low, held = [], k + 1, 0

    return docs.select("doc_id", "text", *turns).mapInArrow(
        turned,
        f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def _batch(ids: pa.Array, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, f.type) for values, f in zip(zip(*[r[:-1] for r in rows]), list(schema)[1:])]
    texts = pa.array([r[-1] for r in rows], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, *columns, texts], schema=schema)


def restored(turned: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """The table with ``text``, rebuilt from ``output`` and ``form`` alone, in place of ``output``.

    Other columns stay, but for one called ``text``. A null output or form gives a null text.
    """
    marks = _check(sentinels)
    kept = [c for c in turned.columns if c not in ("output", "text")]
    schema = ", ".join(f"`{c}` {turned.schema[c].dataType.simpleString()}" for c in kept)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            outputs = batch.column("output").cast(pa.large_binary())
            texts, low, held = [], 0, 0
            for k, form in enumerate(forms):
                raw = outputs[k].as_py()
                texts.append(None if raw is None or form is None else put_back(raw, form, marks))
                held += len(raw or b"")
                if held >= BATCH or k + 1 == batch.num_rows:
                    part = batch.slice(low, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in kept], pa.array(texts, pa.binary()).cast(pa.string())],
                        names=[*kept, "text"],
                    )
                    texts, low, held = [], k + 1, 0

    return turned.select(*kept, "output").mapInArrow(back, f"{schema}, text string")
