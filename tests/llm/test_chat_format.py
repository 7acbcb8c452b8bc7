"""Quotation linking against a plain version that reads one conversation after another."""

import random
import re
import textwrap

from postlens.llm import chat_format

RUN = 4


def _level(line):
    m = re.match(r"((?:[ \t]*>)+)[ \t]?", line)
    return (m.group(1).count(">"), line[m.end():].strip(" ")) if m else (0, line.strip(" "))


def _passages(text):
    out = []
    for line in re.split(r"\r?\n", text or ""):
        level, bare = _level(line)
        if out and out[-1][0] == level and out[-1][1] == (not bare):
            out[-1][2].append(line)
            out[-1][3].append(bare)
        else:
            out.append((level, not bare, [line], [bare]))
    return out


def _runs(words):
    return {" ".join(words[i:i + RUN]) for i in range(len(words) - RUN + 1)} or {" ".join(words)}


def _plain(rows):
    """{(conv, turn): (thread, parent, depth, n_linked, body)} of rows with distinct (conv, turn)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1], r[3]) for r in rows if r[0] == conv)
        said = {}
        for turn, text in mine:
            for level, blank, _, bare in _passages(text):
                if level == 0 and not blank:
                    for h in _runs(" ".join(bare).lower().split()):
                        said.setdefault(h, turn)
                    for line in bare:
                        if 0 < len(line.split()) < RUN:
                            said.setdefault(" ".join(line.lower().split()), turn)
        parent, top, depth = {}, {}, {}
        for turn, text in mine:
            votes, body, n_linked = {}, [], 0
            for level, blank, lines, bare in _passages(text):
                if level and blank:
                    continue
                runs = _runs(" ".join(bare).lower().split()) if level else set()
                found = {}
                for h in runs:
                    if said.get(h, turn) < turn:
                        found[said[h]] = found.get(said[h], 0) + 1
                n, of = max(((n, t) for t, n in found.items()), default=(0, None))
                if level and 2 * n >= len(runs):
                    n_linked += len(lines)
                    if level == 1:
                        votes[of] = votes.get(of, 0) + n
                else:
                    body += lines
            parent[turn] = max(((n, t) for t, n in votes.items()), default=(0, None))[1]
            up = parent[turn]
            top[turn], depth[turn] = (turn, 0) if up is None else (top[up], depth[up] + 1)
            out[conv, turn] = (top[turn], up, depth[turn], n_linked, "\n".join(body).strip(" \t\r\n"))
    return out


def _got(spark, rows):
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    return {(r.conv_id, r.turn): (r.thread, r.parent_turn, r.depth, r.n_linked, r.body) for r in chat_format.chat_messages(spark, df).collect()}


def test_equals_plain_version(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["The", "a", "of"]
    rows = []
    for conv in range(24):
        bodies = []
        for turn in range(rng.choice([1, 6, 25])):
            parts = []
            for _ in range(rng.randint(0, 2)):
                if bodies:
                    quoted = rng.choice(bodies[-6:] if rng.random() < 0.8 else bodies)
                    words = quoted.split()
                    if rng.random() < 0.4:
                        words = words[rng.randrange(len(words)):]
                    if rng.random() < 0.3:
                        words = [rng.choice(vocab) if rng.random() < 0.3 else w for w in words]
                    mark = rng.choice(["> ", ">", ">> ", "> > "])
                    parts.append("\n".join(mark + x for x in textwrap.wrap(" ".join(words).upper(), rng.choice([12, 30, 70]))))
                    parts.append(rng.choice(["", ">"]))
            own = " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 9, 30])))
            bodies.append(own)
            parts.append("\n".join(textwrap.wrap(own, 40)))
            rows.append((f"c{conv}", turn, "u", rng.choice(["\n", "\r\n"]).join(parts)))
    want = _plain(rows)
    assert sum(w[1] is not None for w in want.values()) > 30 and any(w[2] > 2 for w in want.values())
    assert _got(spark, rows) == want


def test_wrapped_anew(spark):
    said = "Could you send the figures of last week before Friday noon so that we can close the books in time"
    again = "\n".join("> " + x for x in textwrap.wrap(said, 25))
    got = _got(spark, [("c", 0, "a", said), ("c", 1, "b", again + "\n\nYes."), ("c", 2, "a", ">> Could you send the figures\n>> of last week\n> Yes.\nThanks")])
    assert got["c", 1] == (0, 0, 1, again.count("\n") + 1, "Yes.")
    assert got["c", 2] == (0, 1, 2, 3, "Thanks")


def test_everyone_quotes_one_message(spark):
    """A hot key in both joins, and a chain of replies deeper than two passes."""
    rows = [("c", 0, "a", "the words that all of them quote")] + [("c", i, "b", "> the words that all of them quote\nsaid %d x" % i) for i in range(1, 300)]
    rows += [("d", 0, "a", "line 0 x")] + [("d", i, "a", f"> line {i - 1} x\nline {i} x") for i in range(1, 40)]
    got = _got(spark, rows)
    assert all(got["c", i] == (0, 0, 1, 1, f"said {i} x") for i in range(1, 300))
    assert all(got["d", i] == (0, i - 1, i, 1, f"line {i} x") for i in range(1, 40))


def test_long_message_in_linear_time(spark):
    import time

    def seconds(n):
        text = "\n".join(f"{'> ' if i % 3 else ''}word{i} and some more words" for i in range(n))
        t = time.time()
        assert _got(spark, [("c", 0, "a", text)])["c", 0][4] == text
        return time.time() - t

    seconds(100)
    assert seconds(40_000) < 6 * seconds(10_000) + 3
