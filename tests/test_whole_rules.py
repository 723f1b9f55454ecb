"""The registered rule queries on all signals, against plain Python."""

import re
from collections import Counter, defaultdict

import __spark_entry__
from plumbline.functions import patterns

TEXTS = [
    "A calm and friendly place with a large garden, good tea and patient people at the door.",
    "See https://example.com/a today, everyone at this place was kind and the soup was good.",
    "Use code SAVE2025 at the desk, they gave us a good table near the window that evening.",
    "It cost $25 and 20% off for the second plate, which we found a fair thing all in all.",
    "We were glad #happy to be here with the whole family on such a quiet autumn morning.",
    "Sooooo good, we went back the next day and sat in the same corner by the old stove.",
    "I heard it is bad and I was told to stay away, so I have never been there in my life.",
    "My iphone screen broke again and the new laptop is slow, which has nothing to do here.",
    "Call me now at 555-123-4567 or a@b.com, www.x.com bit.ly/abc dm us use code GET50OFF $5 #ad 10% off",
    "Wow!!! \U0001F600\U0001F600\U0001F600 sooo bit.ly/xy",
    "Wow!!! \U0001F600\U0001F600\U0001F600 sooo bit.ly/xy",
    "",
]


def plain(texts, categories):
    """A row a text: the scores by name, all texts being of one place."""
    python = lambda p: re.compile(p.replace("(?iU)", "(?i)").replace("(?U)", ""))
    hits = lambda name, t: len(python(patterns.lexicon(patterns.LEXICONS[name])).findall(t))
    same = Counter(texts)
    for t, c in zip(texts, categories, strict=True):
        flags = {k: bool(python(p).search(t)) for k, p in patterns.FLAGS.items()}
        ads = (sum(flags.values()) + min(1, hits("promo", t)) + min(1, hits("contact", t))) / 14
        short = len(re.findall(r"\w+", t)) <= 8
        emoji = len(re.findall("[\U0001F300-\U0001FAFF\u2600-\u27BF\U0001F1E6-\U0001F1FF]", t)) >= 3
        punct, long_ = bool(re.search(r"[!?.,;:/|_*\u2026-]{2,}", t)), bool(re.search(r"(.)\1{2,}", t))
        spam = (short + flags["has_short_url"] + emoji + punct + long_ + (same[t] >= 2)) / 6
        yield {"ads": ads, "spam": spam, "irrelevant": float(hits("offtopic", t) > 0 and c not in t.lower()), "rant": float(hits("nonvisit", t) > 0)}


def test_all_signals(spark, tmp_path):
    langs = ["zz"] * len(TEXTS)
    docs = [(i, t, g, "a", len(t)) for i, (t, g) in enumerate(zip(TEXTS, langs, strict=True))]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    queries, cut = __spark_entry__.queries(), {"ads": 0.4, "spam": 0.6, "irrelevant": 0.5, "rant": 0.5}
    got = {int(r.review_id): r for r in queries["rules_scores_whole"](spark, str(tmp_path)).collect()}
    total = defaultdict(int)
    for i, want in enumerate(plain(TEXTS, langs)):
        for k, x in want.items():
            assert abs(got[i][f"rule_{k}_score"] - x) < 1e-8, (i, k)
            assert got[i][f"rule_{k}_strong"] == (x >= cut[k])
            total[k] += x >= cut[k]
        assert got[i].rule_none == (not any(x >= cut[k] for k, x in want.items()))
        total["none"] += got[i].rule_none
    assert all(total.values()) and len(total) == 5
    assert [r.asDict() for r in queries["rules_by_place_whole"](spark, str(tmp_path)).collect()] == [{"gmap_id": "a", "n": len(TEXTS), **total}]
