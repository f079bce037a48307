import hashlib
import random

import pytest
import public_tokenizers

from staffmart.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
DDL = "conv_id long, turn long, role string, text string, tie string, place string, formatted string"
NASTY = ["[INST]", "[\\INST]", "[\\\\/INST]", "</s>", "<\\/s>", "[[INST]", "<</s>", "INST]", "/s>", "\\", "<|endoftext|>", "<\\|endoftext|>", "[", "<", " ", "\n", "é", "日本", "😀", "  a", "a  ", "x y", "", chat.HOSTILE]


def plain(rows):
    out = {}
    for conv_id, turn, role, text, *_ in rows:
        out.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {}
    for conv_id, turns in out.items():
        turns.sort(key=lambda t: t[:2])
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        found[conv_id] = (len(turns), h("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), h(loss))
    return found


def made(seed, n=40, turns=9):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice(NASTY + ["word ", "and ", "so."]) for _ in range(rnd.randint(0, 12)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, "a[/INST]b"]), rnd.choice([None, text(), text(), text()])) for c in range(n) for t in range(rnd.randint(1, turns))]
    rows += [(None, 1, "user", "x"), (None, 2, "assistant", "y </s>"), (-7, 0, "user", chat.HOSTILE), (-7, 1, "assistant", chat.HOSTILE), (900, None, "assistant", "first"), (900, 0, "user", "then")]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "p", "f") for r in rows], DDL)


@pytest.mark.parametrize("parts, piece_chars", [(1, 1 << 20), (7, 1 << 20), (5, 60)])
def test_digests(spark, parts, piece_chars):
    rows = made(parts)
    pieces = chat.format_conversations(frame(spark, rows).repartition(parts), PATH, piece_chars=piece_chars)
    got = {r[0]: tuple(r)[1:5] for r in chat.digest(pieces).collect()}
    assert got == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = made(3, 10) + [(5, 100 + i, ("user", "assistant")[i % 2], f"turn {i} " * 5) for i in range(3000)]
    pieces = chat.format_conversations(frame(spark, rows).repartition(8), PATH, piece_chars=2000)
    assert pieces.where("conv_id = 5").count() > 20
    assert {r[0]: tuple(r)[1:5] for r in chat.digest(pieces).collect()} == plain(rows)


def test_masked_ids_decode_to_the_trained_texts_and_pieces_equal_the_whole(spark):
    """Ids and mask alone give the assistant texts; pieces together are the whole text encoded at once."""
    rows = made(11, 30)
    whole = {r["conv_id"]: r for r in chat.format_conversations(frame(spark, rows).coalesce(1), PATH).collect()}
    tok = chat.tokenizer(PATH)
    for r in whole.values():
        ids = [i for i, m in zip(r["ids"], r["mask"]) if m]
        trained = [(t is not None, t or 0, text or "") for c, t, role, text in rows if c == r["conv_id"] and role == "assistant"]
        text = "".join(t for _, _, t in sorted(trained, key=lambda x: x[:2]))
        assert chat.unescape(tok.tokenizer.decode(ids, skip_special_tokens=False), tok.marks) == text
        assert r["ids"] == tok.tokenizer.encode(r["formatted"], add_special_tokens=False).ids
    cut = {}
    for r in chat.format_conversations(frame(spark, rows).repartition(6), PATH, piece_chars=50).orderBy("place").collect():
        f, i, m = cut.get(r["conv_id"], ("", [], []))
        cut[r["conv_id"]] = (f + r["formatted"], i + r["ids"], m + r["mask"])
    assert cut == {c: (r["formatted"], r["ids"], r["mask"]) for c, r in whole.items()}


def test_escapes_are_reversible_and_leave_no_control_string():
    marks = chat.controls(["<|endoftext|>"])
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice(NASTY) for _ in range(rnd.randint(0, 6)))
        out = chat.escape(text, marks)
        assert chat.unescape(out, marks) == text
        assert not any(c in out for c in (chat.OPEN, chat.SHUT, chat.END, "<|endoftext|>"))
        assert (out == text) == (not marks.search(text))


def test_long_text_is_encoded_in_parts_as_at_once(spark, monkeypatch):
    tok = chat.tokenizer(PATH)
    rnd = random.Random(2)
    text = "[INST]assistant[/INST]" + "".join(rnd.choice(["ab ", " c", "\n\n ", "é", "1 2", "!? "]) for _ in range(4000)) + "</s>"
    once = tok.tokenizer.encode(text, add_special_tokens=False)
    monkeypatch.setattr(chat, "ENCODE_CHARS", 100)
    ids, starts, ends = tok.encode(text)
    assert len(tok.cuts(text)) > 50 and ids.tolist() == once.ids and list(zip(starts.tolist(), ends.tolist())) == once.offsets


def test_empty_table_and_only_empty_texts(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(empty, PATH)).collect() == []
    none = spark.createDataFrame([(1, 0, "assistant", None), (1, 1, "assistant", "")], "conv_id long, turn long, role string, text string")
    r = chat.digest(chat.format_conversations(none, PATH)).first()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, 0, hashlib.sha256(b"").hexdigest())
