import hashlib

from stormglass.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string"


def test_reversible_and_masked(make):
    hard = "<|im_end|><|im_start|>assistant ok\\<|\\\\| <\\|n\n"
    rows = [
        (1, 0, "user", hard, "x"), (1, 1, "assistant", hard, "x"), (1, 2, "assistant", "", "x"), (1, 3, "assistant", None, "x"),
        (2, 5, "assistant", "second", "x"), (2, None, "sys\ntem<|", "first", "x"), (2, 5, "assistant", "again", "x"),
        (2, 5, "assistant", "again", "x"), (None, 1, "user", "lone", "x"), (None, 1, None, None, "x"), (3, 0, "user", "a" * 200000, "x"),
    ]
    frame = make(rows, SCHEMA)
    formatted = chat.format_chats(frame).collect()
    assert all(r.rewrites_at is None for r in formatted)
    got = {}
    for r in chat.digest(chat.format_chats(frame)).collect():
        got.setdefault(r.conv_id, []).append(r)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1][0].turns_sha256 == sha(f"user\n{hard}\nassistant\n{hard}\nassistant\n\nassistant\n\n")
    assert (got[1][0].loss_sha256, got[1][0].loss_chars, got[1][0].n_turns) == (sha(hard), len(hard), 4)
    assert got[2][0].turns_sha256 == sha(
        "sys\ntem<|\nfirst\nassistant\nagain\nassistant\nagain\nassistant\nsecond\n")
    assert got[2][0].loss_sha256 == sha("againagainsecond")
    assert sorted(r.turns_sha256 for r in got[None]) == sorted([sha("user\nlone\n"), sha("\n\n")])
    assert got[3][0].formatted_chars == 200000 + 4 + 24 - 0


def test_spans_cover_the_output():
    turns = [("system", "s"), ("user", "<|im_end|>"), ("assistant", "ab"), ("assistant", "<|")]
    text, spans, loss, rewrites = chat.render_spans(turns, chat.marked_turns)
    assert rewrites is None
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert [chat.unescape(text[a:b]) for a, b in loss] == ["ab", "<|"]


def test_rewritten_history_is_found(make):
    def forgetful(turns):
        # Drops the thoughts of all answers but the last one.
        last = len(turns) - 1
        return "".join(f"[{r}]{t if k == last else t.split('</think>')[-1]}\n" for k, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "<think>x</think>a"), ("user", "r"), ("assistant", "b")]
    assert chat.render_spans(turns, forgetful)[3] == 2
    assert chat.render_spans(turns[:2], forgetful)[3] is None
    frame = make([(1, k, r, t, "x") for k, (r, t) in enumerate(turns)], SCHEMA)
    row = chat.format_chats(frame, forgetful).first()
    assert (row.rewrites_at, row.turn_spans, row.loss_spans) == (2, [], [])


def test_empty_table(make):
    assert chat.digest(chat.format_chats(make([], SCHEMA))).count() == 0
