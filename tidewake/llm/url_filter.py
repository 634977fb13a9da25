"""URL filtering with pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``: ``*`` matches anything, a leading ``||`` anchors it at the start of the host or of one of
its labels, ``|`` at either end anchors it there, ``^`` is a separator (no letter, digit or ``_-.%``) or the end, and a
leading ``@@`` makes it an exception, which lets a URL pass that others would block.  Patterns do not regard case, listed
rules do in the path.  Each rule is filed under the literal token of its pattern that is rarest among the URLs at hand;
the tokens of a URL fetch candidate rules and only those candidates run their regular expression.  Everything is a column
expression: up to ``INLINE_RULES`` rules travel as a constant, an array of hash buckets in which a token looks into
one place alone, and the plan has no exchange at all; larger rule sets are joined on the token
(broadcast only below ``BROADCAST_RULES`` rules).

Edge cases: a null URL, or one without ``://``, has an empty host and path, no rule and the
default verdict; an empty table gives an empty result; repeated rows are judged each on its own; very
long URLs are read whole; of rules that fit, listed ones come first, then exceptions, then the longest, then the last by
name; of a table's columns the identifier and the URL alone are read, others may have any name.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import ascii_lower

INLINE_RULES = 20_000
COUNTED_TOKENS = 256
BROADCAST_RULES = 200_000
_RULE_TYPE = "struct<token:string,name:string,regex:string,verdict:string,listed:boolean,exception:boolean,size:int>"
_ORDER = ("listed", "exception", "size", "name", "verdict")
#: The seed that Spark's own ``xxhash64`` starts from.
_SEED = 42


_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported for listed rules; ``listed`` rules take precedence over plain patterns."""

    name: str
    pattern: str
    verdict: str
    listed: bool = False

    @staticmethod
    def prefix(spec: str, verdict: str) -> "Rule":
        """``host/path``: the host with all its subdomains, and the paths that start with ``/path``."""
        return Rule(spec, f"||{spec}*", verdict, listed=True)

    @staticmethod
    def line(text: str) -> "Rule":
        """A line of a filter list."""
        return Rule(text, text.removeprefix("@@"), "allow" if text.startswith("@@") else "block")

    @property
    def exception(self) -> bool:
        return not self.listed and self.verdict == "allow"

    @property
    def _parts(self) -> tuple[str, str, str]:
        """The anchors at both ends and what stands between them."""
        head = next(x for x in ("||", "|", "") if self.pattern.startswith(x))
        tail = "|" if self.pattern.endswith("|") and len(self.pattern) > len(head) else ""
        return head, self.pattern[len(head) : len(self.pattern) - len(tail)], tail

    @property
    def regex(self) -> str:
        head, body, tail = self._parts
        start = {"||": r"^(?:[^/]*\.)?", "|": "^", "": ""}[head]
        inner = r"[\s\S]*".join(_SEPARATOR.join(re.escape(x) for x in part.split("^")) for part in (body if tail else body.rstrip("*")).split("*"))
        return ("" if self.listed else "(?i)") + start + inner + (r"\z" if tail else "")

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that any matching URL holds whole: runs of letters and digits with an end, a separator or another literal on both sides."""
        head, body, tail = self._parts
        found = []
        for m in re.finditer(r"[A-Za-z0-9]+", body):
            left = body[m.start() - 1] != "*" if m.start() else bool(head)
            right = body[m.end()] != "*" if m.end() < len(body) else bool(tail)
            if left and right:
                found.append(m[0].lower())
        return found


#: Fixed rules of the production query: prefixes of host and path, longest wins.
LISTED = (
    Rule.prefix("org/", "allow"),
    Rule.prefix("example.org/es/", "block"),
    Rule.prefix("example.org/en/1", "block"),
    Rule.prefix("com/fr/", "allow"),
    Rule.prefix("com/de/", "block"),
)
#: Filter lines of the production query: hosts that serve advertisements or count visits, hosts that sell by their name, pages
#: without prose, and what is let through all the same.
LINES = """
||ad.*^
||ads.*^
||adserver.*^
||banner.*^
||beacon.*^
||click.*^
||counter.*^
||doubleclick.*^
||metrics.*^
||pixel.*^
||stats.*^
||track.*^
||tracker.*^
||tracking.*^
.casino.
||casino-
-casino.
||free-bets.
||bet-
-bets.
-betting.
||cheap-
||discount-
-jackpot.
-loans.
||lottery-
-lottery.
-payday.
-pharmacy.
-pills.
||poker-
-poker.
-slots.
-watches.
/ads/
/adverts/
/banner/
/basket^
/cart^
/cgi-bin/
/checkout^
/login^
/logout^
/my-account^
/register^
/session^
/signin^
/signup^
/wp-admin^
/wp-login.php|
;jsessionid=
|localhost^
@@||ads.txt^
@@||docs.*^
@@/login-help^
@@||help.*/register^
""".split()
PATTERNS = tuple(Rule.line(x) for x in LINES)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.concat(host, path)), "[^A-Za-z0-9]+"))


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many rows each of the rules' own tokens occurs: one row of counts, as wide as the rule set is."""
    if not tokens:
        return {}
    if len(tokens) <= COUNTED_TOKENS:
        row = urls.agg(*[F.count_if(F.array_contains("tokens", t)).alias(f"c{i}") for i, t in enumerate(tokens)]).first()
        return {t: row[f"c{i}"] or 0 for i, t in enumerate(tokens)}
    wanted = urls.sparkSession.createDataFrame([(t,) for t in tokens], "token string")
    wanted = F.broadcast(wanted) if len(tokens) <= BROADCAST_RULES else wanted
    seen = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    return dict.fromkeys(tokens, 0) | {r["token"]: r["count"] for r in seen.collect()}


def index_rules(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without a literal token stand under the empty string."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(key, []).append(rule)
    return index


def _fields(token: str, rule: Rule) -> dict:
    return {"token": token, "name": rule.name, "regex": rule.regex, "verdict": rule.verdict, "listed": rule.listed, "exception": rule.exception, "size": len(rule.name)}


def _fetched(tokens: Column, index: dict[str, list[Rule]]) -> Column:
    """The rules filed under any of ``tokens``, and those without a token: one bucket of a constant array each."""
    size = 1 << max(1, 2 * len(index) - 1).bit_length()
    buckets: list[list[dict]] = [[] for _ in range(size)]
    for token, found in index.items():
        if token:
            buckets[xxhash.xxh64_intdigest(token.encode(), seed=_SEED) & (size - 1)] += [_fields(token, r) for r in found]
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{_RULE_TYPE}>>")
    place = lambda t: (F.pmod(F.xxhash64(t), F.lit(size)) + 1).cast("int")
    hits = F.flatten(F.transform(tokens, lambda t: F.filter(F.element_at(table, place(t)), lambda r: r["token"] == t)))
    always = F.from_json(F.lit(json.dumps([_fields("", r) for r in index.get("", [])])), f"array<{_RULE_TYPE}>")
    return F.concat(always, hits)


def _best(rules: Column) -> Column:
    """Listed rules first, then exceptions, then the longest, then by name."""
    return F.array_max(F.transform(rules, lambda r: F.struct(*[r[name].alias(name) for name in _ORDER])))


def judge(pages: DataFrame, rules: tuple[Rule, ...], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, pattern`` for every row of ``pages``."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    index = index_rules(rules, token_counts(urls, sorted({t for r in rules for t in r.tokens})))
    subject = F.concat("host", "path")
    if len(rules) <= INLINE_RULES:
        hits = F.filter(_fetched(F.col("tokens"), index), lambda r: F.regexp_like(subject, r["regex"]))
        judged = urls.withColumn("best", _best(hits))
    else:
        judged = _joined(urls, index, subject)
    best = F.col("best")
    return judged.select(
        id_col,
        "host",
        "path",
        F.when(best["listed"], best["name"]).alias("rule"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
        F.when(~best["listed"], best["name"]).alias("pattern"),
    )


def _joined(urls: DataFrame, index: dict[str, list[Rule]], subject: Column) -> DataFrame:
    """Beyond ``INLINE_RULES``: candidates by a join on the token, one row a URL afterwards."""
    spark: SparkSession = urls.sparkSession
    rows = [(token, r.name, r.regex, r.verdict, r.listed, r.exception, len(r.name)) for token, found in index.items() for r in found]
    table = spark.createDataFrame(rows, "token string, name string, regex string, verdict string, listed boolean, exception boolean, size int")
    if len(rows) <= BROADCAST_RULES:
        table = F.broadcast(table)
    keyed = urls.withColumn("row", F.monotonically_increasing_id())
    asked = keyed.withColumn("token", F.explode(F.array_distinct(F.concat("tokens", F.array(F.lit("")))))).drop("tokens")
    hit = F.regexp_like(subject, F.col("regex"))
    found = asked.join(table, "token", "left").withColumn("hit", F.when(hit, F.struct(*_ORDER)))
    first = [c for c in urls.columns if c != "tokens"]
    return found.groupBy("row").agg(*[F.first(c).alias(c) for c in first], F.max("hit").alias("best"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), LISTED + PATTERNS)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PATTERN_ROWS = ", ".join(f"({_quoted(r.name)}, {_quoted(r.regex)}, {_quoted(r.verdict)}, {str(r.exception).lower()})" for r in PATTERNS)
SQL = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(name, rhost, rpath, rverdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
), patterns(name, regex, pverdict, exception) AS (
  VALUES {_PATTERN_ROWS}
), plain AS (
  SELECT page_id, max(struct_pack(e := exception, n := length(name), q := name, v := pverdict)) AS p FROM split JOIN patterns ON regexp_matches(host || path, regex) GROUP BY page_id
), judged AS (
  SELECT s.*, (SELECT max(struct_pack(n := length(name), name := name, v := rverdict)) FROM rules
               WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
  FROM split s
)
SELECT page_id, host, path, best.name AS rule, CASE WHEN best IS NOT NULL THEN best.v ELSE coalesce(p.v, 'allow') END AS verdict,
       CASE WHEN best IS NULL THEN p.q END AS pattern
FROM judged LEFT JOIN plain USING (page_id)
"""
