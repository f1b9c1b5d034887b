import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from osm_tables.llm import divergence as D
from tests.llm.helpers import odd_texts

SCHEMA = "doc_id bigint, text string, lang string, source string, value int, rank string, term string"


def made(sources=7, seed=4):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'éü日Ab'[i % 5]}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "de", None])
        source = f"s{min(rng.randrange(sources), rng.randrange(sources))}" if rng.random() < 0.9 else None
        text = "".join(rng.choice(words[: 40 + 80 * (i % 2)]) + rng.choice([" ", ", ", "1", "\n"]) for _ in range(rng.randrange(60)))
        rows.append((i, text, lang, source, 1, "r", "t"))
    rows += [(1000 + i, t, "en", "odd", 1, "r", "t") for i, t in enumerate(odd_texts())]
    rows += [(2000, None, "en", "empty", 1, "r", "t"), (2001, "only a few", "xx", "a", 1, "r", "t"), (2002, "", "xx", "b", 1, "r", "t")]
    rows += [(2003, "alone", "yy", "a", 1, "r", "t"), rows[3], rows[3], (None, rows[5][1], "en", "s0", 1, "r", "t")]
    rows.append((3000, "long words repeat " * 20_000, "en", "s1", 1, "r", "t"))
    return rows


def by_hand(rows):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, c in docs[lang].items() if c >= 10)
        total = Counter()
        for s in sources:
            total.update({t: n[lang, s][t] for t in kept})

        def share(counts, kept=kept):
            whole = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (whole + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(n[lang, s]) for s in sources}, share(total)
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(-f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, 10)):
                ordered = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(ordered)]
    return sorted(out)


def found(spark, rows, sizes=D.SIZES):
    got = D.audit(spark.createDataFrame(rows, SCHEMA).repartition(4), sizes=sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    rows = made()
    if small:  # many pages, blocks, products and flushes, and joins by shuffles
        monkeypatch.setattr(D, "BROADCAST_GROUPS", 1)
        assert found(spark, rows, D.Sizes(16, 3, 20, 50, 64)) == by_hand(rows)
    else:
        assert found(spark, rows) == by_hand(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_joint_values_are_sums_of_prices():
    rng = np.random.default_rng(3)
    left, right = rng.integers(1, 40, (500, 4)) * 10_000_019, rng.integers(1, 900, (500, 3)) * 1_000_003
    expected = np.array([[D.price(left[:, i], right[:, j]).sum() for j in range(3)] for i in range(4)])
    assert (D.joint_values(left, right) == expected).all()
    assert (np.diag(D.joint_values(left, left)) == 0).all()


def test_long_texts_are_cut_between_terms():
    text = "Ab" * 50 + " " + "c, dé " * 30
    whole = D.term_counts(text.encode())
    assert D.term_counts(text.encode(), 7) == whole == Counter({("ab" * 50).encode(): 1, b"c": 30, "dé".encode(): 30})
