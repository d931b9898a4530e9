"""Personal data by weak supervision, with DataFrame and SQL functions only.

Base spans come from four patterns with their checks (``BASE``). Further
candidates, assignments, identifiers with an issuer's prefix and long ones that mix
letters and digits, which may be credentials, are voted
on by regex, gazetteer and context labelers, each of which may abstain.
Expectation-maximisation over the table of vote patterns (two classes, labelers
independent given the class) estimates the labelers' reliabilities, and its
posteriors train the final span classifier, a naive Bayes model on hashed span
features. Candidates that it accepts and that meet no base span are added as ``secret``.

Spans are code points, end exclusive. A null or empty text has no spans. Matches
are found by splitting the text, so whole texts of any length are searched;
offsets are summed in runs of ``RUN`` matches. Repeated rows have equal results.
Without candidates nothing is learned and nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed

# Quantifiers are possessive where nothing could be given back, and a run that has
# failed once isn't tried again from its middle; both keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
ISSUED_PREFIXES = "AKIA ASIA ghp_ gho_ github_pat_ sk- sk_live_ pk_live_ xoxb- xoxp- AIza".split()
NAME = "(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]++"  # of any length, with a letter
CANDIDATE = (rf'(?<![A-Za-z0-9_-]){NAME} ?[=:] ?"?[^\s"=:]{{8,}}+"?'
             rf"|(?<![A-Za-z0-9])(?:{'|'.join(ISSUED_PREFIXES)})[A-Za-z0-9_-]{{10,}}+"
             r"|(?<![A-Za-z0-9])(?=[0-9]*+[A-Z])[A-Z0-9]{16,}+(?![A-Za-z0-9])"
             r"|(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[a-z0-9]*+[A-Z])(?=[A-Z0-9]*+[a-z])[A-Za-z0-9]{16,}+")

# What a text must hold for an alternative of CANDIDATE to match, cheap to test.
GATES = ["{t} RLIKE '[=:] ?\"?[^\\\\s\"=:]{8}'", *(f"contains({{t}}, '{p}')" for p in ISSUED_PREFIXES),
         "{t} RLIKE '(?<![A-Za-z0-9])[A-Z0-9]{16}'", "{t} RLIKE '(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+(?<=[A-Za-z0-9]{16})'"]

_LUHN = ("aggregate(sequence(1, length({d})), 0, (a, i) -> a + "
         "element_at(IF(i % 2 = 1, array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9), array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)), "
         "ascii(substring(reverse({d}), i, 1)) - 47)) % 10 = 0")
_CARD_DIGITS = "regexp_replace(m.found, '[ -]', '')"
# kind: (pattern, what a text must contain to be searched, check of a match m)
BASE = {
    "email": (EMAIL, "contains({t}, '@')", "true"),
    "ip": (IP, r"{t} RLIKE '[0-9]\\.[0-9]'",
           r"forall(transform(split(m.found, '\\.'), p -> ltrim('0', p)), p -> length(p) < 3 OR (length(p) = 3 AND p <= '255'))"),
    "card": (CARD, "{t} RLIKE '[0-9](?:[ -]?[0-9]){15}'",
             f"IF(length({_CARD_DIGITS}) BETWEEN 16 AND 19, {_LUHN.format(d=_CARD_DIGITS)}, false)"),
    "phone": (PHONE, "contains({t}, '+')", "length(regexp_replace(m.found, '[^0-9]', '')) BETWEEN 8 AND 15"),
}
ADDED = "secret"

# Fixed word lists of the labelers.
KEY_NAMES = ("password passwd pwd pass secret token apikey api_key api-key access_key auth auth_token bearer credential "
             "private_key client_secret session").split()
CUES = "login user account credentials password secret token key".split()

RUN = 512
BUCKETS = 512
ROUNDS = 40
BELIEF, STRENGTH = 0.9, 10.0  # a labeler is taken to be right so often, with the weight of so many votes
ACCEPT = 0.5


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find_all(text: str, pattern: str, when: str) -> str:
    """SQL for all leftmost non-overlapping matches: array of (start, end, found).
    The pieces between the matches give the offsets."""
    step = ("aggregate({rows}, named_struct('at', {at}, 'out', CAST(array() AS array<struct<start: int, end: int, found: string>>)), (a, r) -> "
            "named_struct('at', a.at + length(r.piece) + length(r.found), 'out', array_append(a.out, named_struct("
            "'start', a.at + length(r.piece), 'end', a.at + length(r.piece) + length(r.found), 'found', r.found))))")
    inner = step.format(rows=f"slice(z, c, {RUN})", at="o.at")
    pairs = f"zip_with(f, slice(split({text}, {_sql(pattern)}, -1), 1, size(f)), (x, y) -> named_struct('found', x, 'piece', y))"
    found = (f"transform(array(regexp_extract_all({text}, {_sql(pattern)}, 0)), f -> transform(array({pairs}), z -> "
             f"flatten(aggregate(IF(size(z) = 0, CAST(array() AS array<int>), sequence(1, size(z), {RUN})), "
             "named_struct('at', 0, 'runs', CAST(array() AS array<array<struct<start: int, end: int, found: string>>>)), "
             f"(o, c) -> transform(array({inner}), n -> named_struct('at', n.at, 'runs', array_append(o.runs, n.out)))[0], o -> o.runs)))[0])[0]")
    return f"CASE WHEN {when.replace("{t}", text)} THEN {found} ELSE CAST(array() AS array<struct<start: int, end: int, found: string>>) END"


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a column base_<kind>, array of (start, end, found), for each kind."""
    found = df.withColumns({f"_{k}": F.expr(find_all(text, p, when)) for k, (p, when, _) in BASE.items()})
    return found.withColumns({f"base_{k}": F.expr(f"filter(_{k}, m -> {check})") for k, (_, _, check) in BASE.items()}).drop(*[f"_{k}" for k in BASE])


def candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with base_<kind> and candidates: (start, end, found, value, name, left), those that meet base spans left out."""
    df = base_spans(df, text)
    met = " OR ".join(f"exists(base_{k}, b -> b.start < c.end AND c.start < b.end)" for k in BASE)
    value = rf"""regexp_replace(c.found, '^{NAME} ?[=:] ?"?|"$', '')"""
    fields = (f"named_struct('start', c.start, 'end', c.end, 'found', c.found, 'value', {value}, "
              rf"'name', lower(regexp_replace(regexp_extract(c.found, '^({NAME}) ?[=:]', 1), '[_-]?[0-9]+$', '')), "
              f"'left', lower(substring({text}, greatest(1, c.start - 23), least(24, c.start))))")
    found = df.withColumn("_found", F.expr(find_all(text, CANDIDATE, " OR ".join(GATES))))
    return found.withColumn("candidates", F.expr(f"transform(filter(_found, c -> NOT ({met})), c -> {fields})")).drop("_found")


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(_sql(w) for w in words) + ")"


# Labelers: SQL over a candidate c that votes 1 (personal), 0 (not) or NULL (abstains).
LABELERS = {
    "regex_mixed": "IF(c.value RLIKE '[0-9]' AND c.value RLIKE '[A-Za-z]', 1, 0)",
    "regex_opaque": "CASE WHEN c.value RLIKE '^(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{12,}$' OR c.value RLIKE '^(?=[0-9]*+[A-Z])[A-Z0-9]{20}$' THEN 1 "
                    "WHEN c.value RLIKE '[aeiouAEIOU][a-z]+[aeiouAEIOU]' AND NOT c.value RLIKE '[0-9]' THEN 0 END",
    "gazetteer_name": f"CASE WHEN exists({_array(KEY_NAMES)}, k -> c.name = k OR endswith(c.name, concat('_', k)) OR endswith(c.name, concat('-', k))) THEN 1 "
                      "WHEN c.name <> '' THEN 0 END",
    "gazetteer_prefix": f"IF(exists({_array(ISSUED_PREFIXES)}, p -> startswith(c.value, p)), 1, NULL)",
    "context_cue": f"IF(exists({_array(CUES)}, w -> contains(c.left, w)), 1, NULL)",
    "context_url": "IF(c.value LIKE '//%' OR c.name LIKE 'http%' OR c.name IN ('mailto', 'ftp'), 0, NULL)",
}

# Features of a candidate c for the classifier.
FEATURES = ("array(concat('name=', regexp_extract(c.name, '[^_-]*$', 0)), concat('prefix=', substring(c.value, 1, 4)), "
            "concat('length=', cast(least(length(c.value), 40) div 4 as string)), "
            "concat('digits=', cast(length(regexp_replace(c.value, '[^0-9]', '')) * 4 div length(concat(c.value, '.')) as string)), "
            "concat('shape=', substring(regexp_replace(regexp_replace(regexp_replace(c.value, '[a-z]+', 'a'), '[A-Z]+', 'A'), '[0-9]+', '9'), 1, 12)), "
            "concat('last=', regexp_replace(substring(c.left, -2, 2), '[a-z0-9]', 'w')))")


def estimate(patterns: list[tuple[tuple, int]], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], list[float]]:
    """EM over vote patterns (votes, count): the share of true candidates, each
    labeler's chances of voting 1 on a true and on a false one, and each pattern's posterior."""
    n = len(patterns[0][0])
    post = [(1 + sum(v for v in votes if v)) / (2 + sum(v is not None for v in votes)) for votes, _ in patterns]
    for _ in range(rounds):
        total = sum(c for _, c in patterns)
        prior = (1 + sum(p * c for p, (_, c) in zip(post, patterns))) / (2 + total)
        rates = []
        for i in range(n):
            said = [(p, votes[i], c) for p, (votes, c) in zip(post, patterns) if votes[i] is not None]
            true, false = sum(p * c for p, _, c in said), sum((1 - p) * c for p, _, c in said)
            rates.append(((BELIEF * STRENGTH + sum(p * c for p, v, c in said if v)) / (STRENGTH + true),
                          ((1 - BELIEF) * STRENGTH + sum((1 - p) * c for p, v, c in said if v)) / (STRENGTH + false)))
        post = []
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (true, false) in zip(votes, rates):
                if v is not None:
                    odds += math.log(true / false) if v else math.log((1 - true) / (1 - false))
            post.append(1 / (1 + math.exp(-max(-500, min(500, odds)))))
    return prior, rates, post


def train(df: DataFrame, text: str) -> list[float]:
    """Weights of the span classifier: by bucket, and last the bias. Empty without candidates."""
    return train_on(candidates(df, text))


def train_on(found: DataFrame) -> list[float]:
    """``train`` for rows that have their candidates."""
    rows = found.select(F.explode("candidates").alias("c"))
    votes = [F.expr(sql).alias(name) for name, sql in LABELERS.items()]
    buckets = F.transform(F.expr(FEATURES), lambda f: F.pmod(F.xxhash64(f), F.lit(BUCKETS))).alias("buckets")
    voted = checkpointed(rows.select(*votes, buckets).groupBy(*LABELERS, "buckets").count())
    table = voted.groupBy(*LABELERS).agg(F.sum("count").alias("n")).collect()  # 3 ^ labelers rows at most
    if not table:
        return []
    _, _, post = estimate([(tuple(r)[:-1], r["n"]) for r in sorted(table, key=str)])
    posterior = voted.sparkSession.createDataFrame(
        [(*tuple(r)[:-1], p) for r, p in zip(sorted(table, key=str), post)], ", ".join(f"{k} int" for k in LABELERS) + ", post double")
    same = None
    for k in LABELERS:
        same = voted[k].eqNullSafe(posterior[k]) if same is None else same & voted[k].eqNullSafe(posterior[k])
    weighted = voted.join(posterior, same).select("buckets", (F.col("post") * F.col("count")).alias("true"), ((1 - F.col("post")) * F.col("count")).alias("false"))
    true, false = weighted.agg(F.sum("true"), F.sum("false")).first()
    counted = weighted.select(F.explode(F.array_distinct("buckets")).alias("bucket"), "true", "false").groupBy("bucket").agg(
        F.sum("true").alias("true"), F.sum("false").alias("false")).collect()  # a row for each bucket
    weights = [0.0] * BUCKETS
    for bucket, t, f in counted:
        weights[bucket] = math.log((t + 0.5) / (true + 1)) - math.log((f + 0.5) / (false + 1))
    return [*weights, math.log((true + 0.5) / (false + 0.5))]


def all_spans(df: DataFrame, text: str, weights: list[float]) -> DataFrame:
    """``df`` with base_<kind> and added, arrays of (start, end, found)."""
    return with_added(candidates(df, text) if weights else base_spans(df, text), weights)


def with_added(found: DataFrame, weights: list[float]) -> DataFrame:
    """The candidates that the classifier accepts, in place of all, as column added."""
    if not weights:
        return found.drop("candidates").withColumn("added", F.expr("CAST(array() AS array<struct<start: int, end: int, found: string>>)"))
    *table, bias = weights
    array = "array(" + ", ".join(f"{w!r}D" for w in table) + ")"
    score = f"aggregate(array_distinct(transform({FEATURES}, f -> pmod(xxhash64(f), {BUCKETS}))), {bias!r}D, (a, b) -> a + element_at({array}, cast(b as int) + 1))"
    least = math.log(ACCEPT / (1 - ACCEPT))
    return (found.withColumn("added", F.expr(f"transform(filter(candidates, c -> {score} >= {least!r}D), c -> named_struct('start', c.start, 'end', c.end, 'found', c.found))"))
            .drop("candidates"))


def joined(kinds: dict[str, str]) -> Column:
    """kind:start:end of the spans in columns by kind, in the order given, joined by commas."""
    parts = ", ".join(f"transform({c}, s -> concat('{k}:', s.start, ':', s.end))" for k, c in kinds.items())
    return F.expr(f"array_join(flatten(array({parts})), ',')")


def redacted(text: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    spans = ", ".join(f"transform({c}, s -> named_struct('start', s.start, 'end', s.end, 'kind', '[{k.upper()}]'))"
                      for k, c in [*((k, f"base_{k}") for k in BASE), (ADDED, "added")])
    step = (f"IF(s.start >= a.at, named_struct('at', s.end, 'out', concat(a.out, array(substring({text}, a.at + 1, s.start - a.at), s.kind))), "
            "named_struct('at', greatest(a.at, s.end), 'out', a.out))")
    return F.expr(f"CASE WHEN {text} IS NULL THEN NULL ELSE aggregate(array_sort(flatten(array({spans}))), "
                  f"named_struct('at', 0, 'out', CAST(array() AS array<string>)), (a, s) -> {step}, "
                  f"a -> concat(array_join(a.out, ''), substring({text}, a.at + 1))) END")
