"""Chat formatting against a brute-force reading of the source rows."""

import hashlib
import random

import pytest

from varloom.llm.chat_format import INSTRUCTION, ConversationReader, NoTurn, Template, chat_report, format_turns

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, loss_start int"
BITS = ["</s>", "[INST]", "[/INST]", "<<SYS>>", "<", "[", "/INST]", "&", "&#", "&#91;", "&#38;#91;", "38;", "[OUT]", "[ROLE]", "[TEXT]", "é", "😀", "\n", " ", "s>", "ok"]


def made(seed=0, n=300):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))
    rows = [(rng.randint(0, 40), t, rng.choice(["user", "assistant", "system", "tool", "", text()]), text()) for t in range(n)]
    return rows + [(-1, None, None, None), (-1, 0, "assistant", None), (None, 1, "user", "x"), (None, 0, "assistant", "y"), (-2, 0, "user", "z" * 2_000_000),
                   (-3, 5, "assistant", "same"), (-3, 5, "assistant", "same")]


def wanted(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {conv: (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(len(t) for r, t in turns if r == "assistant"),
                   sha("".join(t for r, t in turns if r == "assistant"))) for conv, turns in found.items()}


def test_report_equals_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    found = chat_report(docs).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == wanted(rows) and len(found) == len(wanted(rows))
    assert chat_report(docs.limit(0)).count() == 0


def test_texts_keep_no_control_string(spark):
    rows = made(3)
    pieces = format_turns(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)).collect()
    assert len(pieces) == len(rows)
    for p in pieces:
        role, start, end, stop = INSTRUCTION.read_turn(p.formatted)
        assert role == p.role and stop == len(p.formatted) and not INSTRUCTION.marker.search(p.formatted[start:end])
        assert (p.loss_start, p.loss_end) == ((start, end) if role == "assistant" else (None, None))


def test_only_conflicts_are_escaped():
    assert INSTRUCTION.render("user", "a < b & c [d]")[0] == "[INST]a < b & c [d][/INST]"
    assert INSTRUCTION.render("user", "</s>&#60;")[0] == "[INST]&#60;/s>&#38;#60;[/INST]"


def test_pieces_may_be_cut_anywhere():
    turns = [("user", "a</s>"), ("tool", "[TEXT]"), ("assistant", "b&#91;")]
    whole, reader = "".join(INSTRUCTION.render(r, t)[0] for r, t in turns), ConversationReader(1, INSTRUCTION)
    for char in whole:
        reader.feed(char, None, None)
    assert reader.row()[1:3] == (3, hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
    reader.feed("[INST]open", None, None)
    with pytest.raises(ValueError, match="ends inside"):
        reader.row()
    with pytest.raises(NoTurn):
        INSTRUCTION.read_turn("[INST]a</s>")


def test_templates_whose_markers_overlap_with_texts():
    odd = Template({"user": ("aa", "ab")}, ("ba", "bb", "cc"))
    for role, text in [("user", "a"), ("user", "aab"), ("tool", "bcb"), ("b", "a"), ("user", "&#97;a")]:
        turn, start, end = odd.render(role, text)
        assert odd.read_turn(turn)[0] == role and odd.unescape(turn[start:end]) == text
    with pytest.raises(ValueError):
        Template({"user": ("<", "<x")}, ("1", "2", "3"))
