import math
from collections import Counter

import pytest

from tidemark.llm import url_filter as U
from tidemark.llm.registry import URL_RULES

PAGES = [
    (1, "http://a.net/x", "a.net", "/x", "net/", "block"),
    (2, "https://sub.example.net/en/page?q=1#t", "sub.example.net", "/en/page", "example.net/en/", "allow"),
    (3, "https://EXAMPLE.net/de/", "example.net", "/de/", "net/", "block"),
    (4, "http://notexample.com/de/a", "notexample.com", "/de/a", None, None),
    (5, "http://www.example.com/de/a", "www.example.com", "/de/a", "example.com/de/", "block"),
    (6, "http://x.org/fr/1", "x.org", "/fr/1", "org/fr/", "allow"),
    (7, "http://x.net", "x.net", "", None, None),
    (8, "http://x.net?a=/b", "x.net", "", None, None),
    (9, "no scheme/net/", "", "", None, None),
    (10, None, "", "", None, None),
    (11, "", "", "", None, None),
    (12, "a://b.org/fr/x://y.net/z", "b.org", "/fr/x://y.net/z", "org/fr/", "allow"),
    (13, "http://x.org/FR/1", "x.org", "/FR/1", None, None),
    (14, "http://net/" + "long" * 5000, "net", "/" + "long" * 5000, "net/", "block"),
    (15, "http://x.org/fr/a\nb?c", "x.org", "/fr/a\nb", "org/fr/", "allow"),
]


def test_parts_rules_and_columns(spark):
    df = spark.createDataFrame([p[:2] for p in PAGES] + [(6, PAGES[5][1])], "page_id long, url string")
    df = df.selectExpr("*", "'other' as host", "'other' as rule", "1 as row", "2 as gram")
    rows = U.judge_urls(df, URL_RULES).collect()
    assert len(rows) == len(PAGES) + 1
    found = {r.page_id: r for r in rows}
    for page, _, host, path, rule, verdict in PAGES:
        r = found[page]
        assert (r.host, r.path, r.rule) == (host, path, rule), page
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def plain_ratio(examples, url):
    """The two models without Spark."""
    fold = lambda u: "".join("0" if c in "0123456789" else c if c in U.LETTERS else U.OTHER for c in u.lower())
    scores = []
    for label in (1, 0):
        counts = Counter()
        for text, of in examples:
            if of == label:
                padded = "^" * (U.ORDER - 1) + fold(text)
                for i in range(U.ORDER - 1, len(padded)):
                    for k in range(U.ORDER):
                        counts[padded[i - k : i + 1]] += 1

        def p(gram):
            if not gram:
                return 1 / U.SYMBOLS
            followers = [n for g, n in counts.items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
            if not followers:
                return p(gram[1:])
            return (counts[gram] + len(followers) * p(gram[1:])) / (sum(followers) + len(followers))

        padded = "^" * (U.ORDER - 1) + fold(url)
        scores.append(sum(math.log(p(padded[i - U.ORDER + 1 : i + 1])) for i in range(U.ORDER - 1, len(padded))))
    return (scores[0] - scores[1]) / len(url)


def test_scores_match_plain_models(spark):
    good = [f"http://good{i}.org/fr/{i}" for i in range(30)]
    bad = [f"http://spam-{i}.net/buy%{i}" for i in range(30)]
    free = ["http://good99.com/q", "http://spam-77.com/buy%7", "http://ümlaut.com/é"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + free)], "page_id long, url string")
    rows = {r.page_id: r for r in U.judge_urls(df, URL_RULES).collect()}
    held = {r.url for r in df.selectExpr("url", f"pmod(xxhash64(url), {U.HELD_OUT}) = 0 as h").collect() if r.h}
    examples = [(u, 1) for u in good if u not in held] + [(u, 0) for u in bad if u not in held]
    for i, url in enumerate(free, 60):
        assert rows[i].score == pytest.approx(plain_ratio(examples, url))
    assert rows[60].score > rows[61].score


@pytest.mark.parametrize("urls", [[], ["http://x.com/"], ["http://x.org/fr/"]])
def test_missing_classes(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert len(U.judge_urls(df, URL_RULES).collect()) == len(urls)
