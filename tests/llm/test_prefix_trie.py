import hashlib
import random
import zlib

import pytest

from tidegate.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_turn(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            one = hashlib.md5(f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), one, pair))
    return {c: [p for *_, p in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        n = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:n] + own[n:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    below = {n: [0, 0, 0] for n in members}
    for n in sorted(members, key=len, reverse=True):
        below[n][1] += below[n][0] == 0
        below[n][2] += (len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
        if n:
            above = below[n[:-1]]
            above[0] += 1
            above[1] += below[n][1]
            above[2] += below[n][2]
    digest = lambda n: hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), *below[n], digest(n)) for n, m in members.items()), key=repr)


@pytest.fixture(scope="module")
def rows():
    draw, out = random.Random(13), []
    texts = ["", "a", "é", "b" * 40, None, "c"]
    for c in range(160):
        for t in range(draw.choice([1, 1, 2, 3, 5, 9])):
            out.append((c, t, draw.choice(["user", "assistant", None]) if t > 2 else "user", draw.choice(texts[: 2 if t < 2 else 6])))
    out += [(500 + i, t, "user", f"same {t}") for i in range(90) for t in range(3)]  # a common conversation
    out += [(800, t, "user", f"long {t % 7}") for t in range(600)] + [(801, 0, None, "x" * 100_000)]
    return out + [(None, 0, "user", "a"), (900, None, "user", "a"), (900, 0, "user", "b"), (900, None, "user", "0"), (901, 1, "r", "t"), (901, 1, "r", "t")]


def nodes(df):
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.conversations(df)))
    return sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("cells, fan", [(1 << 18, 256), (40, 2), (700, 3)])
def test_nodes_equal_brute_force(frame, rows, monkeypatch, by_value, cells, fan):
    monkeypatch.setattr(prefix_trie, "CELLS", cells)  # small blocks and rounds make most nodes boundary nodes
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    by_value(prefix_trie)
    assert nodes(frame(rows, SCHEMA)) == brute(rebuilt(by_turn(rows)))


def test_turnless_conversations_are_members_of_the_root(frame):
    # Heads of an absent conversation: nothing is left of those that are shorter than their head.
    short = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:6]
    rows = [(c, 0, "user", "a") for c in short]
    assert nodes(frame(rows, SCHEMA)) == brute(rebuilt(by_turn(rows)))
    assert nodes(frame(rows, SCHEMA))[0][1:5] == (0, None, 6, 0)


def test_empty_table(frame):
    assert nodes(frame([], SCHEMA)) == []
