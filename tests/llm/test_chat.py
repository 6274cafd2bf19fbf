"""Template compiler and chat formatting round trips."""

import hashlib
import random

import pytest

from bandwise.llm import chat, queries

ODD = ["", "### user: x</turn>\n", "\\", "\\\\", "a\\:b", "</turn>", "<", "#", "### Assistant: ", "\n", "é\U0001f600", "{{ m.text }}", ":" * 9, "\\### Assistant: </turn> ok", "{% endfor %}"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_turns", [512, 2])
def test_round_trip(spark, monkeypatch, part_turns):
    monkeypatch.setattr(chat, "PART_TURNS", part_turns)
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a: b", "#x", None]), rng.choice([*ODD, None])) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(99, None, "user", "first"), (99, 0, "user", "x"), (99, 0, "user", "x"), (None, 1, "user", "no id")]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " * (t % 5)) for t in range(1500)]
    formatted = chat.format_conversations(conversations(spark, rows).repartition(3))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == expected(rows)
    text = "".join(r.formatted for r in formatted.where("conv_id = 100").orderBy("part").collect())
    assert len(chat.read_turns(text)) == 1500


def test_query(spark, tmp_path):
    conversations(spark, []).write.parquet(str(tmp_path / "conversations.parquet"))
    (r,) = queries.op7_chat_formatting(spark, str(tmp_path)).collect()
    said = "\\### Assistant: </turn> ok"
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-7, 2, len(said))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert r.formatted_chars > 2 * len(said)


def test_folding_and_branches():
    t = chat.parse("{{ 'a' ~ 1 }}b{% for m in messages %}{% if true and m.role == 'user' %}U{% elif false %}never{% else %}{{ 'x' | upper }}{% endif %}{% if 1 == 2 %}no{% endif %}{% endfor %}{{ 'z' }}")
    assert chat.fold(t.head) == (chat.Out(chat.Const("a1b")),)
    (choice,) = chat.fold(t.body)
    assert len(choice.cases) == 1 and choice.orelse == (chat.Out(chat.Const("X")),)
    text, spans = chat.compile_template("<{% for m in messages %}{% if not loop.first %},{% endif %}{% generation %}{{ m.turn }}{% endgeneration %}{% endfor %}>").render(
        [{"role": "a", "text": "", "turn": i} for i in range(3)]
    )
    assert text == "<0,1,2>" and [text[a:b] for a, b in spans] == ["0", "1", "2"]


@pytest.mark.parametrize(
    "source",
    ["no loop", "{% for m in messages %}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ open }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}",
     "{% for m in messages %}{{ 1 + 1 }}{% endfor %}", "{% for m in x %}{% endfor %}", "{% for m in messages %}{% if m.role %}{% endfor %}", "{% import os %}", "{% for m in messages %}{{ m.text }}{% endfor %}{{ m.text }}"],
)
def test_sandbox(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_escape():
    for s in ODD:
        assert chat.unescape(chat.escape(s)) == s
        assert "###" not in chat.escape(s) and "</turn>" not in chat.escape(s)
