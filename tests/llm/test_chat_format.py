import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from squadweave.llm import chat_format as C

T = C.Template()
SCHEMA = "conv_id long, turn long, role string, text string"


def escaped(text):
    controls = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in T.controls)
    return re.sub(controls, lambda found: found[0][0] + "\\" + found[0][1:], text)


def brute(rows):
    """conv_id -> formatted text, turns, masked texts."""
    found = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "")):
        turns = found.setdefault(conv, [])
        turns.append((role or "", text or ""))
    return {
        conv: (
            "".join(f"<|im_start|>{escaped(role)}<|im_sep|>{escaped(text)}<|im_end|>" for role, text in turns),
            turns,
            [text for role, text in turns if role == "assistant"],
        )
        for conv, turns in found.items()
    }


def joined(parts):
    """conv_id -> formatted text and masked pieces, from collected parts."""
    found = {}
    for row in sorted(parts, key=lambda r: r.part):
        text, pieces = found.setdefault(row.conv_id, ["", []])
        raw = row.formatted.encode()
        pieces += [raw[a:b].decode() for a, b in zip(row.loss_starts, row.loss_ends, strict=True)]
        found[row.conv_id][0] = text + row.formatted
    return found


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_digests(rows):
    return {
        (conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len("".join(masked)), digest("".join(masked)), len(text))
        for conv, (text, turns, masked) in brute(rows).items()
    }


def invented(seed, conversations, most):
    pick = random.Random(seed)
    pieces = ["hi ", "<s>", "</s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_sep|>", "\\", "<", "[", "\n", "é", "中😀", "", "<\\s>", "|im_end|>"]
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, most)):
            text = "".join(pick.choice(pieces) for _ in range(pick.randint(0, 12)))
            rows.append((conv, turn, pick.choice(["user", "assistant", "system", "<s>tool", None]), pick.choice([text, text, None])))
    return rows


def found_digests(df):
    return {tuple(row) for row in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()}


@pytest.mark.parametrize("part_bytes", [1, 200, C.PART_BYTES])
def test_agrees_with_brute_force(spark, part_bytes):
    rows = invented(part_bytes, 60, 9)
    parts = C.formatted(spark.createDataFrame(rows, SCHEMA).repartition(5), part_bytes=part_bytes)
    expected = brute(rows)
    found = joined(parts.collect())
    assert {conv: (text, pieces) for conv, (text, pieces) in found.items()} == {
        conv: (text, [escaped(x) for x in masked]) for conv, (text, _, masked) in expected.items()
    }
    assert found_digests(C.digests(parts)) == expected_digests(rows)


def test_hot_conversation_is_spread(spark):
    """One conversation holds most rows: several tasks share it, and its digests are those of the whole."""
    rows = [(7, turn, "assistant" if turn % 2 else "user", f"text {turn} </s>") for turn in range(3000)]
    rows += invented(3, 40, 5)[:100]
    rows = [row for row in rows if row[0] != 7 or row[3] is None or row[3].startswith("text")]
    parts = C.formatted(spark.createDataFrame(rows, SCHEMA).repartition(8), part_bytes=4000)
    assert parts.filter("conv_id = 7 and not complete").count() > 8
    assert found_digests(C.digests(parts)) == expected_digests(rows)


def test_complete_rows_are_whole(spark):
    rows = invented(5, 200, 4)
    parts = C.formatted(spark.createDataFrame(rows, SCHEMA)).collect()
    whole = [row.conv_id for row in parts if row.complete]
    assert len(whole) > 150
    assert not set(whole) & {row.conv_id for row in parts if not row.complete}


def test_odd_conversations(spark):
    long = "long <s> text " * 200_000
    rows = [
        (None, None, None, None),
        (None, 1, "user", "no conversation"),
        (1, None, "user", "no turn"),
        (1, 0, None, "no role"),
        (1, 0, "assistant", None),
        (1, 1, "assistant", "twice"),
        (1, 1, "assistant", "twice"),
        (2, 0, "user", ""),
        (3, 0, "assistant", long),
        (3, 1, "<|im_sep|>", "\\</s>\\"),
        (4, 0, "user", "ends with <"),
        (4, 1, "assistant", "s> begins"),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.select("*", *[F.lit("kept").alias(c) for c in ("part", "prefix", "digest", "row", "complete", "n_turns", "formatted")])
    assert found_digests(C.digests(C.formatted(clashing))) == expected_digests(rows)
    assert C.digests(C.formatted(clashing.limit(0))).collect() == []


@given(st.text(alphabet="<[\\/s>INST]|im_endp é", max_size=60))
def test_escape_is_reversible(text):
    escaped_text = T.escape(text.encode())
    assert T.unescape(escaped_text) == text.encode()
    assert escaped_text.decode() == escaped(text)
    assert not any(control.encode() in escaped_text for control in T.controls)


@pytest.mark.parametrize("controls", [("<s>", "x<y"), ("a",), ("<\\s>",)])
def test_controls_that_cannot_be_escaped(controls):
    with pytest.raises(ValueError):
        C.Template(reserved=controls)


def test_scatter_in_pieces(monkeypatch):
    monkeypatch.setattr(C, "COPY_BYTES", 3)
    pool = np.frombuffer(b"abcdefghij", np.uint8)
    out = np.zeros(12, np.uint8)
    source, target, length = (np.array(x) for x in ([2, 0, 9, 4], [0, 5, 5, 6], [5, 0, 1, 6]))
    C.scatter(out, pool, source, target, length)
    assert out.tobytes() == b"cdefgjefghij"
