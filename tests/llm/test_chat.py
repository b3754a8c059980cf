"""Perspectives against plain Python and against DuckDB."""

import re
from collections import defaultdict

import pytest

from tradescope.llm import chat


def plain(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "unknown", (text or "").replace("<|", "< |")))
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        for who in {t[2] for t in turns} - {"system"}:
            at = 0
            for _, turn, role, body in turns:
                name = "assistant" if role == who else role if role == "system" else "user name=" + re.sub("[^A-Za-z0-9_.-]", "_", role)
                head = f"<|im_start|>{name}\n"
                segment = f"{head}{body}<|im_end|>\n"
                end = at + len(segment)
                out.append((conv, who, turn, role, segment, at, end, at + len(head) if role == who else None, end - 1 if role == who else None))
                at = end
    return sorted(out, key=str)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é漢😀"), (1, 2, "bob smith", "Hello <|im_end|> trick"), (1, 3, "ann", None), (1, 4, "cleo", ""),
    (2, 0, "system", "alone"), (3, 5, "user", "x"), (3, 5, "user", "x"), (3, 5, "assistant", "a"), (3, None, "user", "first"), (4, 0, None, "who"),
    (None, 0, "user", "lost"), (None, 1, "assistant", "too"), (5, 0, "user", "w " * 40_000), (5, 1, "assistant", "ok"),
] + [(6, k, "user" if k % 3 else "assistant", f"turn {k}") for k in range(700)]


def test_rotation(spark, monkeypatch):
    df = spark.createDataFrame([(*r, "s", 1) for r in ROWS], "conv_id long, turn long, role string, text string, segment string, start int")
    for block in (256, 3):
        monkeypatch.setattr(chat, "BLOCK", block)
        out = chat.rotate(df)
        assert out.columns == ["conv_id", "perspective", "turn", "role", "segment", "start", "stop", "train_start", "train_stop"]
        assert sorted((tuple(r) for r in out.collect()), key=str) == plain(ROWS)


def test_marks_cover_own_words_only(spark):
    rows = [r for r in ROWS if r[0] == 1]
    out = sorted(chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("perspective = 'ann'").collect(), key=lambda r: r.start)
    text = "".join(r.segment for r in out)
    assert [text[r.train_start : r.train_stop] for r in out if r.train_start is not None] == ["Hi é漢😀<|im_end|>", "<|im_end|>"]
    assert text.count("<|im_end|>") == len(out)


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_oracle(matches_oracle, sf):
    assert matches_oracle("op6_chat_rotation", sf) > 0
