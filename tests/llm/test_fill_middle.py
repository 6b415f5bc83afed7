"""Fill-in-middle form against plain slicing, and back."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from kindred.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, form string, n string, output string, h1 string"


def plain(doc_id, text, seed=42, changed=50, suffix_first=80, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in marks) or h[2] % 100 >= changed:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:first], units[first:second], units[second:]))
    p, s, m = marks
    if h[3] % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def texts():
    draw = random.Random(3)
    made = ["".join(draw.choices("ab é世🙂 \n\t\x0b <>PSM", k=draw.randint(0, 60))) for _ in range(400)]
    return [
        None, "", " ", "\n\n", "one", " one", "one ", "a<P>b c", "<S>", "x <M", "<P<", "a < P> b",
        "nospace" * 1000, " " * 5000, "world 世界 " * 3000, *made, made[0], made[0],
    ]


def rows(spark, some):
    data = [(i if i % 13 else None, t, "f", "n", "o", "h") for i, t in enumerate(some)]
    return spark.createDataFrame(data, DOCS)


def compared(spark, some, **options):
    docs = rows(spark, some)
    turned = fill_middle.fill_in_middle(docs, **options)
    got = sorted(map(tuple, turned.collect()), key=repr)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    names = {"sentinels": "marks"}
    wanted = {names.get(k, k): v for k, v in options.items()}
    assert got == sorted([(i, *plain(i, t, **wanted)) for i, t in given], key=repr)
    back = fill_middle.restored(turned, options.get("sentinels", fill_middle.SENTINELS))
    assert back.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text"]
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=repr) == sorted(
        [(i, t or "") for i, t in given], key=repr
    )
    return {r[2] for r in got}


def test_forms_equal_plain_slicing_and_come_back(spark):
    assert compared(spark, texts()) == {"plain", "spm", "psm"}
    assert compared(spark, texts(), seed=7, changed=100, suffix_first=0) == {"plain", "psm"}
    other = ("⟨p⟩", "⟨suffix⟩", "⟨m⟩")
    assert compared(spark, texts(), changed=100, sentinels=other) == {"plain", "spm", "psm"}


def test_short_scans_and_swaps_change_nothing(spark, monkeypatch):
    import hypothesis
    from hypothesis import strategies as st

    monkeypatch.setattr(fill_middle, "SCAN", 7)
    monkeypatch.setattr(fill_middle, "SWAP", 3)
    marks = [b"<P>", b"<S>", b"<M>"]

    @hypothesis.settings(max_examples=300, deadline=None)
    @hypothesis.given(st.text(alphabet="ab é\n <>", max_size=60), st.data())
    def check(text, data):
        units = UNIT.findall(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        assert fill_middle.count_units(raw) == len(units)
        a = data.draw(st.integers(0, len(units)))
        b = data.draw(st.integers(a, len(units)))
        first, second = fill_middle.cut_places(raw, (a, b))
        assert text.encode()[:first] == "".join(units[:a]).encode()
        assert text.encode()[:second] == "".join(units[:b]).encode()
        for form in ("psm", "spm"):
            out = bytes(fill_middle.arranged(text.encode(), first, second, form, marks))
            assert fill_middle.put_back(out, form, marks) == text.encode()

    check()


def test_rotation_exchanges_neighbours():
    for low, joint, high in [(0, 0, 9), (0, 9, 9), (2, 5, 9), (0, 1, 200_001)]:
        raw = bytes(random.Random(high).randbytes(high + 5))
        buffer = bytearray(raw)
        fill_middle.rotate(buffer, low, joint, high)
        assert bytes(buffer) == raw[:low] + raw[joint:high] + raw[low:joint] + raw[high:]


def test_sentinels_that_can_be_mistaken_are_refused(spark):
    for bad in [("<P>", "<S>", "<S>"), ("", "a", "b"), ("ab", "bc", "d"), ("aba", "c", "d"), ("abc", "b", "d")]:
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(rows(spark, ["x"]), sentinels=bad)


def test_empty_table_and_a_huge_text(spark):
    assert fill_middle.restored(fill_middle.fill_in_middle(rows(spark, []))).collect() == []
    assert compared(spark, ["word é " * 700_000] * 3, changed=100) <= {"plain", "spm", "psm"}
