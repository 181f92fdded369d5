"""URL filters (operator 2): host rules, then a weighted vocabulary found by Aho-Corasick.

A rule is a host with a path prefix; it fits its host and every subdomain when the url's path
starts with the rule's, and the longest fitting rule decides. Where none fits, the vocabulary
does: one automaton over all terms reads the whole url once, query, fragment and urls without a
scheme included, with its percent escapes decoded; a hit counts only between borders (no ASCII
letter or digit beside it). One strict term, or different soft terms whose weights add up to
``soft_limit``, block the url. Forms of one word are one term, and no soft term reaches the limit
alone.

Defined results: a null url is empty; a url without ``://`` has an empty host and path and fits no
rule; repeated rows are judged alike; an empty table gives no rows; long urls are read whole; an
escape of a byte beyond ASCII, or of a control character, is a border; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import LOWER, UPPER, ascii_lower

#: (verdict, host, path prefix)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Terms that reject alone, and soft terms by weight: common url words of adult, gambling, pharmacy,
#: credit, piracy, malware and advertising sites, listed by subject and not from any table. A term is
#: its forms, joined by "/". Weight 3: words of such sites that hardly stand elsewhere, enough with any other term;
#: 2: words that two of make such a site; 1: words of ordinary shops and banks too.
STRICT = (
    "porn/porno/pornhub", "xxx", "xnxx", "xvideos", "hentai", "milf", "camgirl/camgirls", "escort/escorts",
    "casino", "viagra", "cialis", "levitra", "spam", "malware", "phishing", "ransomware", "warez",
)
_SOFT_WORDS = {
    3: "adult/adults sexy nude/nudes/naked erotic/erotica fetish hookup/hookups bet/bets/bettor/betting gamble/gambling poker "
    "roulette blackjack jackpot sportsbook wager pill/pills steroid/steroids payday keygen torrent/torrents nulled",
    2: "sex/sexual webcam/webcams cam/cams dating slot/slots bingo lottery/lotto pharmacy/drugstore meds crack/cracked/cracks "
    "serial/serials hack/hacks/hacked cheat/cheats replica/replicas ad/ads/advert/adverts adserver popup/popups "
    "click/clicks track/tracker/tracking",
    1: "free cheap/cheapest discount/discounts bonus win/winner prize/prizes giveaway coupon/coupons prescription tablets "
    "loan/loans lender/lenders credit debt mortgage forex banner/banners affiliate",
}
SOFT = {term: weight for weight, terms in _SOFT_WORDS.items() for term in terms.split()}
SOFT_LIMIT = 4
ESCAPE = re.compile("%([0-9A-Fa-f]{2})")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(rules: tuple[tuple[str, str, str], ...], host: Column, path: Column) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null. ``rules`` is a short list."""
    found = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def automaton(strict: tuple[str, ...], soft: dict[str, int]) -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for term, weight in [*soft.items(), *[(t, None) for t in strict]]:
        for form in term.split("/"):
            auto.add_word(form, (len(form), term, weight))
    auto.make_automaton()
    return auto


def decoded(url: str) -> str:
    """Percent escapes of printable ASCII as their characters, of other bytes as a space; once."""
    return ESCAPE.sub(lambda m: chr(int(m[1], 16)) if 32 <= int(m[1], 16) < 127 else " ", url) if "%" in url else url


def hits(auto: ahocorasick.Automaton, text: str) -> tuple[int, int]:
    """Different strict terms, and the summed weight of different soft terms, between borders."""
    strict, soft, last = set(), {}, len(text) - 1
    for end, (size, term, weight) in auto.iter(text):
        start = end - size + 1
        before, after = text[start - 1] if start else "", text[end + 1] if end < last else ""
        if (before.isascii() and before.isalnum()) or (after.isascii() and after.isalnum()):
            continue
        if weight is None:
            strict.add(term)
        else:
            soft[term] = weight
    return len(strict), sum(soft.values())


_FOLD = str.maketrans(UPPER, LOWER)


def judge(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, strict: tuple[str, ...] = STRICT,
    soft: dict[str, int] | None = None, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_weight of every page."""
    soft = SOFT if soft is None else soft
    host, path = host_and_path(F.col("url").cast("string"))
    url = F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), url)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(strict, soft)
        for b in batches:
            found = [hits(auto, decoded(u).translate(_FOLD)) for u in b["url"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int32())],
                names=["page_id", "host", "path", "strict_hits", "soft_weight"],
            )

    kind = parts.schema["page_id"].dataType.simpleString()
    scanned = parts.mapInArrow(scan, f"page_id {kind}, host string, path string, strict_hits int, soft_weight int")
    rule = fitting_rule(rules, F.col("host"), F.col("path"))
    own = F.when((F.col("strict_hits") > 0) | (F.col("soft_weight") >= soft_limit), "block").otherwise("allow")
    return scanned.withColumn("_r", rule).select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce(F.col("_r.verdict"), own).alias("verdict"),
        "strict_hits", "soft_weight",
    )


def _vocabulary_sql() -> str:
    rows = [(form, term, weight) for term, weight in [*SOFT.items(), *[(t, 0) for t in STRICT]] for form in term.split("/")]
    return ", ".join(map(repr, rows))


SQL = f"""
WITH u AS (
    SELECT page_id, coalesce(url, '') AS url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, url,
           coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM u
), rules(verdict, h, start) AS (
    VALUES {", ".join(repr(r) for r in RULES)}
), terms(form, term, weight) AS (
    VALUES {_vocabulary_sql()}
), best AS (
    SELECT page_id, max_by(h || start, length(h || start)) AS rule, max_by(verdict, length(h || start)) AS verdict
    FROM (SELECT DISTINCT page_id, host, path FROM p) JOIN rules
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
    GROUP BY page_id
), plain AS (
    SELECT DISTINCT page_id, translate(string_split(url, '%')[1] || array_to_string(list_transform(string_split(url, '%')[2:], lambda x:
        CASE WHEN regexp_matches(x, '^([2-6][0-9A-Fa-f]|7[0-9A-Ea-e])') THEN chr(CAST('0x' || x[1:2] AS INTEGER)) || x[3:]
             WHEN regexp_matches(x, '^[0-9A-Fa-f][0-9A-Fa-f]') THEN ' ' || x[3:] ELSE '%' || x END), ''), '{UPPER}', '{LOWER}') AS t
    FROM p
), found AS (
    SELECT page_id, count(*) FILTER (WHERE weight = 0) AS strict_hits, sum(weight) AS soft_weight
    FROM (SELECT DISTINCT page_id, term, weight FROM plain JOIN terms ON regexp_matches(t, '(^|[^a-z0-9])' || form || '([^a-z0-9]|$)'))
    GROUP BY page_id
)
SELECT page_id, host, path, best.rule,
       coalesce(best.verdict, CASE WHEN strict_hits > 0 OR soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(strict_hits, 0) AS INTEGER) AS strict_hits, CAST(coalesce(soft_weight, 0) AS INTEGER) AS soft_weight
FROM p LEFT JOIN best USING (page_id) LEFT JOIN found USING (page_id)
"""
