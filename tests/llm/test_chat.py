import hashlib
import random

import pytest
from pyspark.errors import PythonException

from tallywell.llm import chat
from tallywell.llm.chat import Renderer, RewrittenHistory, escape, format_turns, marked_turns, parse_turns, rewrites_history, unescape

PIECES = ["<", "|", "\\", "im_start", "|>", "a", "\n", "<|im_end|>", "<|im_start|>", "<\\|", "user", "é", "n"]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_escape_is_reversible():
    for text in texts(1, 3000):
        assert unescape(escape(text)) == text and "<|" not in escape(text)


def test_turns_round_trip():
    made = texts(2, 600)
    for k in range(0, 600, 6):
        turns = list(zip(made[k : k + 3], made[k + 3 : k + 6]))
        assert parse_turns(marked_turns(turns)) == turns


@pytest.mark.parametrize("lookback", [None, 0, 2, 8])
def test_spans_are_found_by_comparing_outputs(lookback):
    made = texts(3, 40)
    turns = [("assistant" if i % 2 else "user", t) for i, t in enumerate(made)]
    renderer, whole = Renderer(marked_turns, lookback), ""
    for role, text in turns:
        added, start, end = renderer.add((role, text))
        assert unescape(added[start:end]) == text
        whole += added
    assert whole == marked_turns(turns)


def forgets(turns):
    """A template that shows only the last text whole."""
    return "".join(f"{r}:{t if i == len(turns) - 1 else t[:1]}|" for i, (r, t) in enumerate(turns))


def with_system(turns):
    """A template that opens with a line of its own and sets the first turn apart."""
    return "".join(("<sys>" if not i else "") + f"[{r}] {t} [/]" for i, (r, t) in enumerate(turns))


def test_rewritten_history_is_detected():
    turns = [("user", "long text"), ("assistant", "answer"), ("user", "x")]
    assert rewrites_history(forgets, turns) and rewrites_history(forgets, turns, lookback=1)
    assert not rewrites_history(marked_turns, turns) and not rewrites_history(with_system, turns, lookback=1)
    renderer = Renderer(forgets)
    renderer.add(turns[0])
    with pytest.raises(RewrittenHistory):
        renderer.add(turns[1])


def brute(turns):
    done = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: tuple((x is not None, x) for x in t[:2]) + (t[2] or "", t[3] or "")):
        done.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, own in done.items():
        loss = "".join(t for r, t in own if r == "assistant")
        all_turns = "".join(f"{r}\n{t}\n" for r, t in own)
        out[conv] = (len(own), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(marked_turns(own)))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, added string, seq int"


def test_digests_match_brute_force(spark):
    rng, made = random.Random(5), texts(6, 400)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, 3, None]), rng.choice(["user", "assistant", None, "tool\nx"]), t or None) for t in made]
    rows += rows[:20]
    rows.append((9, 0, "assistant", "long " * 100_000))
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in chat.format_and_read(frame).collect()}
    assert got == brute(rows)
    assert chat.format_and_read(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rewriting_template_fails_the_job(spark):
    frame = spark.createDataFrame([(1, 0, "user", "abc", "", 0), (1, 1, "assistant", "d", "", 0)], SCHEMA)
    with pytest.raises(PythonException, match="RewrittenHistory"):
        format_turns(frame, lambda turns: "".join(t if i == len(turns) - 1 else "-" for i, (_, t) in enumerate(turns))).collect()


def test_long_conversations_are_rendered_whole(spark):
    def drops_old(turns):
        return "".join(f"{r}:{t}|" for r, t in turns[-20:])

    def numbered(turns):
        return "".join(f"{i} {r}:{t}|" for i, (r, t) in enumerate(turns))

    def alternating(turns):
        assert all(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        return "".join(f"{r}:{t}|" for r, t in turns)

    turns = [("assistant" if i % 2 else "user", f"text {i}") for i in range(30)]
    frame = spark.createDataFrame([(1, i, r, t, "", 0) for i, (r, t) in enumerate(turns)], SCHEMA)
    for template in (numbered, alternating):
        rows = format_turns(frame, template).orderBy("seq").collect()
        assert "".join(r.added for r in rows) == template(turns)
        assert [r.added[r.loss_start : r.loss_end] for r in rows if r.seq % 2] == [t for r, t in turns if r == "assistant"]
    with pytest.raises(PythonException, match="RewrittenHistory"):
        format_turns(frame, drops_old).collect()
    with pytest.raises(ValueError, match="turn_local"):
        format_turns(frame, numbered, lookback=8)
