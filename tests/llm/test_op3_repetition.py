import random
import re
from collections import Counter

from lexforge.llm import repetition as R


def brute(text, rules):
    words = [(m[0], m.start(), m.end()) for m in re.finditer("[^\x20\x09-\x0D]+", text or "")]
    chars = sum(len(w) for w, _, _ in words)
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        if x in seen:
            dup, dup_chars = dup + 1, dup_chars + len(re.sub("[\x20\x09-\x0D]", "", x))
        seen.add(x)
    grams = lambda n: [tuple(w for w, _, _ in words[i : i + n]) for i in range(len(words) - n + 1)]
    count3 = Counter(grams(3))
    repeat = {k for i, g in enumerate(grams(3)) if count3[g] > 1 for k in range(i, i + 3)}
    worst, good = 0.0, dup <= rules.lines * max(len(lines), 1) and dup_chars <= rules.line_chars * max(chars, 1)
    for n, limit in rules.top.items():
        count = Counter(grams(n))
        most = max([c for c in count.values() if c > 1], default=0)
        share = max([min(1.0, c * sum(map(len, g)) / chars) for g, c in count.items() if c == most and most], default=0.0)
        good, worst = good and share <= limit, max(worst, share)
    for n, limit in rules.repeated.items():
        seen, inside = set(), set()
        for i, g in enumerate(grams(n)):
            if g in seen:
                inside.update(range(i, i + n))
            seen.add(g)
        share = sum(len(words[k][0]) for k in inside) / max(chars, 1)
        good, worst = good and share <= limit, max(worst, share)
    failed = len(words) < rules.min_words or 100 * len(repeat) > rules.repeat_percent * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), chars, symbols, dup, len(repeat), failed, not failed and good, round(worst, 9)


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    words = ["a", "bé", "ccc", "dd", "e#", "<f>", "gg\n", "\nh", "日本", "x  "]
    texts = [None, "", " \n ", "\n\n", "a\na", "a\n a\na"] + [" ".join(rnd.choices(words[: rnd.randrange(1, 11)], k=rnd.randrange(120))) for _ in range(150)]
    texts += [" ".join(f"w{i}" for i in range(200)), (" ".join(f"w{i}" for i in range(60)) + "\n") * 3]
    rules = R.RepetitionRules()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in R.repetition(frame).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.worst_gram_share, 9)) == brute(t, rules), (i, t)


def test_edge_rows(docs, no_docs):
    rows = R.repetition(docs).collect()
    assert len(rows) == 10 and not any(r.kept for r in rows)
    assert R.repetition(no_docs).count() == 0
