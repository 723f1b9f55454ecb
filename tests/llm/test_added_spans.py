"""The spans that weak supervision adds: planted near misses, told apart by form, lists and surroundings."""

import random

import pandas as pd

from plumbline.llm import pii


def planted(seed, n):
    """Texts with near misses: (text, [(start, end, kind, personal)])."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card(prefix, length):
        body = prefix + digits(length - len(prefix) - 1)
        return next(body + c for c in "0123456789" if pii.luhn(body + c))

    def phone():
        return rng.choice("23456789") + digits(2) + "-" + rng.choice("23456789") + digits(2) + "-" + digits(4)

    out = []
    for _ in range(n):
        kind, s, lead, personal = rng.choice([
            ("phone", phone(), rng.choice(["call me on my cell ", "phone: ", "tel "]), True),
            ("phone", "0" + digits(2) + "." + digits(3) + " " + digits(4), rng.choice(["part number ", "order ", "serial "]), False),
            ("card", card("4", 13), rng.choice(["visa card ", "my credit card is ", "pay by card "]), True),
            ("card", "9" + digits(1) + " " + digits(5) + "-" + digits(7), rng.choice(["isbn ", "tracking ", "order id "]), False),
            ("email", rng.choice("abc") + "name [at] site [dot] com", rng.choice(["write to ", "e-mail ", "contact "]), True),
            ("email", "meet (at) noon (dot) exe", rng.choice(["version ", "section ", "page "]), False),
        ])
        if kind == "card" and not personal and pii.luhn(pii._digits(s)):
            continue
        more = " , mail x@y.com" if personal and rng.random() < 0.5 else ""
        words = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))
        text = f"{words} {lead}{s}{more} {words}"
        out.append((text, len(words) + 1 + len(lead), len(words) + 1 + len(lead) + len(s), kind, personal))
    return out


def test_added_spans_have_precision_and_recall():
    rows = planted(5, 1500)
    found = [pii._spans(t) for t, *_ in rows]
    counts = pd.DataFrame([s for spans in found for s in spans]).groupby(["kind", "votes", "features"], as_index=False).size().rename(columns={"size": "n"})
    model = pii.train(counts)

    def score(s):
        w = model[s["kind"]]
        return w[-1] + sum(w[i] for i in range(pii.FEATURES) if s["features"] >> i & 1)

    hit = wrong = missed = 0
    for (_, a, b, kind, personal), spans in zip(rows, found, strict=True):
        added = any(not s["base"] and (s["start"], s["end"], s["kind"]) == (a, b, kind) and score(s) >= 0 for s in spans)
        hit += added and personal
        wrong += added and not personal
        missed += personal and not added
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9, (hit, wrong, missed)


def test_expectation_maximisation_against_plain_loops():
    """The same Dawid-Skene steps, candidate by candidate."""
    import math

    rng = random.Random(8)
    k = len(pii.LABELERS)
    each = []
    for _ in range(400):
        truth = rng.random() < 0.4
        v = [rng.choices([1, 0, -1], [0.7, 0.2, 0.1] if truth else [0.1, 0.2, 0.7])[0] for _ in range(k)]
        each.append(tuple(v))
    patterns = sorted(set(each))
    code = lambda v: sum((1 << 2 * i) if x > 0 else (1 << 2 * i + 1) if x < 0 else 0 for i, x in enumerate(v))
    got = pii.reliabilities(pd.DataFrame({"votes": [code(v) for v in patterns], "n": [each.count(v) for v in patterns]}))
    start = {True: (0.1, 0.3, 0.6), False: (0.6, 0.3, 0.1)}
    rate = {y: [list(start[y]) for _ in range(k)] for y in (True, False)}
    prior = 0.5
    for _ in range(50):
        p = []
        for v in each:
            a = math.log(prior) + sum(math.log(rate[True][i][x + 1]) for i, x in enumerate(v))
            b = math.log(1 - prior) + sum(math.log(rate[False][i][x + 1]) for i, x in enumerate(v))
            p.append(1 / (1 + math.exp(max(-50, min(50, b - a)))))
        prior = min(0.999, max(0.001, (sum(p) + 1) / (len(p) + 2)))
        for i in range(k):
            for x in (-1, 0, 1):
                rate[True][i][x + 1] = (sum(q for q, v in zip(p, each, strict=True) if v[i] == x) + 10 * start[True][x + 1]) / (sum(p) + 10)
                rate[False][i][x + 1] = (sum(1 - q for q, v in zip(p, each, strict=True) if v[i] == x) + 10 * start[False][x + 1]) / (len(p) - sum(p) + 10)
    want = {v: q for v, q in zip(each, p, strict=True)}
    assert all(abs(got[i] - want[v]) < 1e-6 for i, v in enumerate(patterns))
