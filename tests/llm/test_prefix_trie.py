"""The conversation trie against a brute-force one: shared heads, copies, long
conversations, nulls, ties, repeated rows, no rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from newsdesk.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, n string"


def brute(rows, rebuild):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    paths = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        paths[c] = by.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for k in range(len(path) + 1):
            members[tuple(path[:k])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        w = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for k in range(len(p) + 1):
            saved[p[:k]] += (len(m) - 1) * w
            leaves[p[:k]] += not children[p]
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest())
                   for p, m in members.items())


def rows_of(seed):
    """Conversations that are copies, beginnings and branches of each other."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), 60):
        n = rng.choice([1, 1, 2, 3, 4, 5, 8, 9, 13])
        same = rng.random() < 0.6
        rows += [(c, t, "user" if t % 2 else "bot", f"w{t} said so" if same else f"turn {rng.randint(0, 2)}  of\n{c % 3}") for t in range(n)]
    rows += [(201, None, None, None), (201, None, "a", ""), (201, 3, "a", None), (202, 5, "u", "one"), (202, 5, "u", "one"), (202, 5, "b", "z"),
             (None, 1, "u", "lost"), (203, 1, None, "x"), (204, 1, "", "x"), (209, 1, "u", "alone"), (2**40, 0, "u", "big"), (-7, 0, "u", "big")]
    rows += [(300 + c, t, "u", f"same {t}") for c in range(3) for t in range(50)] + [(303, t, "u", f"same {t}") for t in range(47)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,span", [(1, 4, 1024), (2, 3, 2), (3, 1, 3)])
def test_trie(spark, monkeypatch, seed, block, span):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    rows = [r for r in rows_of(seed) if r[0] is None or r[0] >= 0 or seed == 1]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)
    if seed == 1:
        assert Counter(tuple(r) for r in prefix_trie.conversation_trie(df).collect()) == brute(rows, False)
    else:
        assert Counter(tuple(r) for r in prefix_trie.shared_prefix_trie(df).collect()) == brute(rows, True)


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.shared_prefix_trie(none).count() == 0
    assert prefix_trie.shared_prefix_trie(spark.createDataFrame([(None, 1, "u", "x", 1, "x", None)], SCHEMA)).count() == 0
