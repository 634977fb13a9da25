import random
import re

import pytest

from tidewake.llm import url_filter
from tidewake.llm.url_filter import LISTED, PATTERNS, Rule

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "https://org/x", "http://a.org/", "http://forg/x", "http://Example.ORG/en/1", "http://example.org/en/123?x#y", "http://sub.example.org/es/a?b=/fr/",
    "http://example.org/es", "http://example.org?x=/es/", "http://example.org#/es/", "http://x.com/fr/a://b", "http://x.com/de/1", "http://com/de/", "ftp://q.net/login/", "http://q.net/a/cart/b", "http://m.casino.example/x",
    "http://www.cheap-pills.net/a", "http://a.ads17.b.net/login/x", "http://ads170.net/", "http://xads1.net/", "http://ads1", "http://cheap-pills/x.y", "http://q.net/spam-farm.", "http://DoubleClick.net/a", "http://xdoubleclick.net/a", "://odd.org/de", "http://x.com/\n/fr/", "http://user@x.com:80/de/", "http://x.com/frx/",
    "http://free-bets.example.net/en/1", "http://m.casino-win.example.net/a", "http://docs.ads.net/", "http://ads.txt/x", "http://a.ads.net", "http://a.net/Login-Help/LOGIN", "http://a.net/wp-login.php", "http://a.net/wp-login.phpx", "http://a.net/cart.html", "http://a.net/cart", "http://help.a.net/x/register", "http://localhost", "http://localhost:8080/", "http://a.net/x;jsessionid=9", "http://cheap-x", "http://a.net/" + "very/long/" * 40 + "ads/x",
]


def fits(rule, subject):
    """One character of the pattern after the other, every way that a star leaves open."""
    pattern = rule.pattern
    head = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    body = pattern[len(head) :]
    tail = body.endswith("|")
    body = body[:-1] if tail else body

    def from_(i, j):
        if i == len(body):
            return not tail or j == len(subject)
        if body[i] == "*":
            return any(from_(i + 1, k) for k in range(j, len(subject) + 1))
        if body[i] == "^":
            return j == len(subject) and from_(i + 1, j) or j < len(subject) and not (subject[j].isascii() and subject[j].isalnum() or subject[j] in "_-.%") and from_(i + 1, j + 1)
        same = j < len(subject) and (subject[j] == body[i] or not rule.listed and subject[j].lower() == body[i].lower())
        return same and from_(i + 1, j + 1)

    labels = [0] + [i + 1 for i, c in enumerate(subject) if c == "." and "/" not in subject[:i]]
    return any(from_(0, j) for j in (labels if head == "||" else [0] if head else range(len(subject) + 1)))


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    hits = [r for r in rules if fits(r, host + path)]
    listed = max((r for r in hits if r.listed), key=lambda r: (len(r.name), r.name), default=None)
    plain = max((r for r in hits if not r.listed), key=lambda r: (r.verdict == "allow", len(r.name), r.name), default=None)
    best = listed or plain
    return host, path, listed.name if listed else None, best.verdict if best else default, plain.name if plain and not listed else None


@pytest.mark.parametrize("inline", [url_filter.INLINE_RULES, 0])
def test_rules_against_brute_force(spark, monkeypatch, inline):
    monkeypatch.setattr(url_filter, "INLINE_RULES", inline)
    shapes = ("|a.ads17", "/x|", "*", "||q.net^*/b|", "@@||q.net^", "@@|odd", "cart", "*cart*", "^b^", "||ads1|", "pills.net/a^", "%", "@@*spam*")
    rules = LISTED + PATTERNS + (Rule.prefix("com/", "block"),) + tuple(Rule.line(x) for x in (shapes if inline else shapes[:2] + shapes[3:]))
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, token string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["pattern"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(URLS * 2)}


def test_listed_rules_by_the_letter(spark):
    rng = random.Random(2)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'a.', 'B.'])}{rng.choice(['example.org', 'example.com', 'org', 'xorg', 'net'])}{rng.choice(['', '/', '/fr/', '/de/x', '/es/', '/en/1', '/en/19', '/en/2', '/es?'])}" for _ in range(300)]
    known = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_filter.judge(pages, LISTED).collect():
        fits = [(h + p, v) for h, p, v in known if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        best = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r["rule"], r["verdict"]) == best


def test_rarest_token_and_empty_table(spark):
    index = url_filter.index_rules(LISTED, {"org": 5, "example": 1, "es": 3, "en": 9, "com": 4, "fr": 2, "de": 9})
    assert {k: [r.name for r in v] for k, v in index.items()} == {"org": ["org/"], "example": ["example.org/es/", "example.org/en/1"], "fr": ["com/fr/"], "com": ["com/de/"]}
    assert Rule("x", "*", "block").tokens == [] and Rule("x", "*ad*", "block").tokens == []
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), LISTED).collect() == []


def test_lines_fire_on_the_pages(spark):
    hit = url_filter.op9_url_filters(spark, "/root/testdata/sf0.1").filter("pattern is not null").select("pattern").distinct().collect()
    assert {"||free-bets.", "||casino-"} <= {r["pattern"] for r in hit}
