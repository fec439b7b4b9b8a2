"""The URL filter as SQL, level by level, for the rules and settings that the query uses.

SQL has to spell the levels out; this holds for paths of up to LEVELS segments.
"""

from postline.llm import url_filter
from postline.llm.url_filter import DIFFER, HEX_NAME, LEAST_LABELS, PRIOR, PURITY, Rule

LEVELS = 12

REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
HOST = f"translate(regexp_extract(coalesce({REST}, ''), '^[^/?#]*', 0), '{url_filter.UPPER}', '{url_filter.LOWER}')"
PATH = f"regexp_extract(coalesce({REST}, ''), '^[^/?#]*([^?#]*)', 1)"
HEX = HEX_NAME.removeprefix("(?i)")


def _segments(path: str) -> str:
    return (
        f"list_transform(list_filter(string_split({path}, '/'), lambda s: s <> ''), lambda s: "
        f"regexp_replace(regexp_replace(s, '{HEX}', '*', 'gi'), '{url_filter.DIGITS}', '*', 'g'))"
    )


def _level(level: int) -> str:
    """The leaves l{level} with templates grown by one segment, as l{level + 1}."""
    labels, others = "(c.good + c.bad)", "(p.good + p.bad - c.good - c.bad)"
    pooled = "(p.bad / nullif(p.good + p.bad, 0))"
    spread = f"sqrt({pooled} * (1 - {pooled}) * (1.0 / nullif({labels}, 0) + 1.0 / nullif({others}, 0)))"
    apart = f"abs(c.bad / nullif({labels}, 0) - (p.bad - c.bad) / nullif({others}, 0)) > {DIFFER} * {spread}"
    differs = f"({labels} >= {LEAST_LABELS} AND {others} >= {LEAST_LABELS} AND coalesce({apart}, false))"
    return f"""
    c{level} AS (SELECT host, template, segments[{level + 1}] AS segment, sum(n) AS n, sum(good) AS good, sum(bad) AS bad
                 FROM l{level} WHERE len(segments) > {level} GROUP BY ALL),
    p{level} AS (SELECT host, template, count(*) AS kids, sum(n) AS n, sum(good) AS good, sum(bad) AS bad
                 FROM c{level} GROUP BY ALL),
    g{level} AS (SELECT c.host, c.template, c.segment,
                        CASE WHEN {differs} OR p.kids = 1 THEN c.segment ELSE '*' END AS grown
                 FROM c{level} c JOIN p{level} p ON c.host = p.host AND c.template = p.template),
    l{level + 1} AS (SELECT l.host, l.segments, l.template || coalesce('/' || g.grown, '') AS template, l.n, l.good, l.bad
                 FROM l{level} l LEFT JOIN g{level} g ON l.host = g.host AND l.template = g.template
                      AND len(l.segments) > {level} AND l.segments[{level + 1}] = g.segment)"""


def _rule(rules: tuple[Rule, ...]) -> str:
    longest = sorted(rules, key=lambda r: (-len(r.name), r.name))
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'" for r in longest
    )
    return f"CASE {cases} END"


def judged_pages(rules: tuple[Rule, ...], labelled: str) -> str:
    """`labelled` is a query of url and bad, which may use {PATH}."""
    verdicts = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in rules)
    levels = ",".join(_level(level) for level in range(LEVELS))
    return f"""WITH labelled AS ({labelled}),
    l0 AS (SELECT {HOST} AS host, {_segments(PATH)} AS segments, '' AS template, count(*)::DOUBLE AS n,
                  count(*) FILTER (bad = 0)::DOUBLE AS good, count(*) FILTER (bad = 1)::DOUBLE AS bad
           FROM labelled GROUP BY 1, 2),{levels},
    share AS (SELECT coalesce(sum(good) / nullif(sum(good) + sum(bad), 0), 1) AS s FROM l0),
    pure AS (SELECT host, template, (sum(good) + {PRIOR} * (SELECT s FROM share)) / (sum(good) + sum(bad) + {PRIOR}) AS purity
             FROM l{LEVELS} GROUP BY ALL),
    named AS (SELECT page_id, {HOST} AS host, {PATH} AS path FROM pages),
    found AS (SELECT page_id, named.host, path, l.template, purity, {_rule(rules).replace("host", "named.host")} AS rule
              FROM named LEFT JOIN l{LEVELS} l ON l.host = named.host AND l.segments = {_segments("path")}
              LEFT JOIN pure ON pure.host = l.host AND pure.template = l.template)
    SELECT page_id, host, path, rule,
           coalesce(CASE rule {verdicts} END, CASE WHEN purity < {PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template
    FROM found"""
