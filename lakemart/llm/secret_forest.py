"""Secret scans: candidates by pattern, false positives removed by a random forest, by built-in functions only.

A candidate is a run of key characters with a digit (or a known prefix), or whatever is assigned to a guarding word:
six characters or more up to white space, or up to the end of its quotes.  The forest sees its length, the transitions between kinds of
characters, how much of it dictionary words cover, the path (source) it comes from and the words beside it.  It is
trained from labelled findings and becomes one SQL expression, so scanning and masking are projections: no row moves,
and no text leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.texts import fresh_name, stored

KEY = "[A-Za-z0-9+/_-]"
RUN = f"(?<!{KEY})(?=AKIA[A-Z]{{16}}|[A-Za-z+/_-]*+[0-9]){KEY}{{16,}}+"
#: Characters before and after a candidate that the forest may look at.
BESIDE = 40
MASK = "[SECRET]"

#: Words that names, placeholders and paths are made of.
DICTIONARY = (
    "account|address|admin|album|api|app|article|base|build|class|client|cluster|code|commit|config|content|data|default|demo|"
    "document|dummy|example|fake|field|file|function|get|group|handler|here|home|html|image|index|insert|item|key|list|local|message|"
    "method|model|module|name|node|number|object|option|page|placeholder|post|process|product|project|query|replace|report|request|"
    "response|sample|secret|server|service|session|set|source|string|system|table|temp|test|text|token|type|update|user|value|version|web|your"
)
#: Words of passwords that people choose, and values that stand where a password would.
CHOSEN = (
    "winter|summer|autumn|spring|dragon|monkey|horse|battery|staple|correct|sunshine|princess|football|welcome|shadow|master|"
    "purple|orange|silver|coffee|letmein|pepper|tiger|london|paris|berlin|guitar|rocket|cookie|flower|marble|thunder"
)
PLAIN = (
    "required|optional|none|null|true|false|string|invalid|missing|changed|reset|protected|expired|incorrect|undefined|unknown|"
    "disabled|enabled|redacted|hidden|changeme|default|empty|removed|forgotten|wrong|should|must|needed|please|enter|cannot|here"
)
#: Words before a secret, and before numbers that are none.
GUARDING = "pass|passwd|password|pwd|secret|token|key|auth|credential|credentials|bearer|apikey|signature"
HARMLESS = "commit|sha|sha1|sha256|md5|checksum|digest|etag|uuid|guid|id|version|revision|build|image|card|order|phone|isbn|base64"

#: What is assigned to a guarding word; single characters are looked at before the words are.
ASSIGNED = r"""["']?\s{0,3}[:=]>?\s{0,3}"""
BEHIND = rf"""(?<=[=:>\s"'])(?<=[=:]>?\s{{0,3}}["']?)(?<=(?i:{GUARDING}){ASSIGNED}["']?)"""
VALUE = rf"""(?:(?<=")[^"\n]{{5,127}}[^"\n](?=")|(?<=')[^'\n]{{5,127}}[^'\n](?=')|[^\s"']{{5,}}[^\s"'.,;)\]])"""
CANDIDATE = f"{BEHIND}{VALUE}|{RUN}"

#: Groups that repeat are possessive: Java's matcher takes them in a loop, where it would recurse into any other.
#: Features of ``c.candidate``, ``c.before``, ``c.after``, ``c.path`` in SQL.
FEATURES = {
    "length": "length(c.candidate)",
    "digits": "regexp_count(c.candidate, '[0-9]') / length(c.candidate)",
    "uppers": "regexp_count(c.candidate, '[A-Z]') / length(c.candidate)",
    "signs": "regexp_count(c.candidate, '[+/_-]') / length(c.candidate)",
    "turns": "regexp_count(c.candidate, '[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])') / length(c.candidate)",
    "case_turns": "regexp_count(c.candidate, '[a-z](?=[A-Z])|[A-Z](?=[a-z])') / length(c.candidate)",
    "vowel_turns": "regexp_count(lower(c.candidate), '[aeiou](?=[bcdfghjklmnpqrstvwxyz])') / length(c.candidate)",
    "variety": "size(array_distinct(split(c.candidate, ''))) / length(c.candidate)",
    "runs": r"regexp_count(c.candidate, '(.)\\1\\1') / length(c.candidate)",
    "coverage": f"1 - length(regexp_replace(lower(c.candidate), '{DICTIONARY}', '')) / length(c.candidate)",
    "hex": "cast(c.candidate rlike '^[0-9a-f]+$' as int)",
    "groups": "cast(c.candidate rlike '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$' as int)",
    "guarding": rf"cast(lower(c.before) rlike '({GUARDING})[^a-z0-9]{{0,6}}$' as int)",
    "harmless": rf"cast(lower(c.before) rlike '({HARMLESS})[^a-z0-9]{{0,6}}$' as int)",
    "assigned": r"""cast(c.before rlike '[=:]\\s*["\']?$' as int)""",
    "strong": r"""cast(lower(c.before) rlike '(pass|passwd|password|pwd|secret)["\']?\\s*[:=]>?\\s*["\']?$' as int)""",
    "others": r"regexp_count(c.candidate, '[^A-Za-z0-9+/_-]') / length(c.candidate)",
    "spaces": r"regexp_count(c.candidate, '\\s') / length(c.candidate)",
    "coded": r"""cast(c.candidate rlike '[(){}<>$]|\\[|^[A-Za-z_]+[.][A-Za-z_.]+$|^[*.xX#?-]+$|^[A-Z]++(?:_[A-Z]++)*+$|^[a-z]++(?:_[a-z]++)++$' as int)""",
    "plain": rf"cast(lower(c.candidate) rlike '^[^a-z]*+(?:{PLAIN}|{DICTIONARY})(?![a-z])(?:[^a-z]++(?:{PLAIN}|{DICTIONARY})(?![a-z]))*+[^a-z]*+$' as int)",
    "quoted": r"""cast(c.after rlike '^["\']' as int)""",
    "test_path": "cast(lower(c.path) rlike 'test|example|sample|mock|fixture|docs?/' as int)",
}


def labelled_findings(spark: SparkSession, rows: int = 10000) -> DataFrame:
    """Findings with labels (candidate, before, after, path, label) of the usual kinds, for training.

    The tables hold no labelled findings, so these are made: keys and passwords as services hand them out, and what is
    often mistaken for them.  ``rows`` bounds them.  Others, with these columns, can take their place.
    """
    hexed = "sha2(concat(id, 'x'), 256)"
    upper = "upper(translate(base64(unhex(sha2(concat(id, 'u'), 256))), '+/=', 'XYZ'))"
    mixed = "translate(base64(unhex(sha2(concat(id, 'm'), 256))), '+/=', 'aB7')"
    word = f"element_at(split('{DICTIONARY}', '[|]'), cast(1 + pmod(xxhash64(id, {{}}), 80) as int))"
    names = f"concat_ws('_', {word.format(1)}, {word.format(2)}, {word.format(3)}, pmod(id, 97))"
    prose = f"concat({word.format(4)}, ' ', {word.format(5)}, ' ')"
    guard = f"element_at(split('{GUARDING}', '[|]'), cast(1 + pmod(xxhash64(id, 6), 13) as int))"
    harmless = f"element_at(split('{HARMLESS}', '[|]'), cast(1 + pmod(xxhash64(id, 7), 17) as int))"
    sign = """element_at(array('=', ': ', ' = "', ' '), cast(1 + pmod(xxhash64(id, 8), 4) as int))"""
    chosen = f"element_at(split('{CHOSEN}', '[|]'), cast(1 + pmod(xxhash64(id, {{}}), 32) as int))"
    plain = f"element_at(split('{PLAIN}', '[|]'), cast(1 + pmod(xxhash64(id, {{}}), 31) as int))"
    strong = "element_at(array('pass', 'passwd', 'password', 'pwd', 'secret', 'DB_PASSWORD', 'user_password'), cast(1 + pmod(xxhash64(id, 11), 7) as int))"
    weak = "element_at(array('token', 'key', 'auth', 'credential', 'credentials', 'bearer', 'signature'), cast(1 + pmod(xxhash64(id, 26), 7) as int))"
    told = """element_at(array('=', ': ', ' = "', '="', ':', " = '"), cast(1 + pmod(xxhash64(id, 12), 6) as int))"""
    mark = "element_at(array('!', '@', '#', '%', '.', '$', '&', '*', '-', ''), cast(1 + pmod(xxhash64(id, {}), 10) as int))"
    year, short = "cast(1950 + pmod(id, 90) as string)", "cast(8 + pmod(xxhash64(id, 13), 8) as int)"
    broken = f"concat(substr({mixed}, 1, 4), {mark.format(14)}, substr({mixed}, 5, cast(1 + pmod(id, 4) as int)), {mark.format(15)}, substr({mixed}, 10, cast(1 + pmod(id, 5) as int)))"
    kinds = [
        (1, f"concat('AKIA', substr({upper}, 1, 16))", prose),
        (1, f"concat('AKIA', substr({upper}, 1, 16))", f"concat({guard}, {sign})"),
        (1, f"substr({hexed}, 1, 18)", f"concat({prose}, 'password=')"),
        (1, f"substr({hexed}, 1, 40)", f"concat({prose}, 'token = \"')"),
        (1, f"substr({hexed}, 1, cast(16 + pmod(id, 40) as int))", f"concat({guard}, {sign})"),
        (1, f"substr({mixed}, 1, cast(20 + pmod(id, 22) as int))", f"concat({guard}, {sign})"),
        (1, f"concat('ghp_', substr({mixed}, 1, 36))", prose),
        (1, f"concat(initcap({chosen.format(21)}), {year}, {mark.format(16)})", f"concat({prose}, {strong}, {told})"),
        (1, f"concat({chosen.format(21)}, pmod(id, 997), {mark.format(16)})", f"concat({prose}, {strong}, {told})"),
        (1, broken, f"concat({strong}, {told})"),
        (1, f"substr({mixed}, 1, {short})", f"concat({prose}, {strong}, {told})"),
        (1, broken, f"concat({guard}, {told})"),
        (1, f"translate(substr({mixed}, 1, cast(18 + pmod(id, 22) as int)), '0123456789', 'ghijKLMNop')", f"concat({guard}, {told})"),
        (1, f"concat_ws(if(id % 2 = 0, '-', ' '), {chosen.format(21)}, {chosen.format(22)}, {chosen.format(23)}, {chosen.format(24)})", f"concat({prose}, {strong}, ' = \"')"),
        (1, f"concat({chosen.format(21)}, {chosen.format(22)})", f"concat({strong}, {told})"),
        (0, plain.format(25), f"concat({prose}, {guard}, {told})"),
        (0, plain.format(25), f"concat({prose}, {strong}, {told})"),
        (0, f"concat({plain.format(25)}, if(id % 2 = 0, ' ', '-'), {word.format(1)})", f"concat({strong}, {told})"),
        (0, word.format(1), f"concat({prose}, {strong}, {told})"),
        (0, f"concat({word.format(1)}, '.', {word.format(2)}, if(id % 2 = 0, '(', '_'), {word.format(3)})", f"concat({strong}, {told})"),
        (0, f"concat({word.format(1)}, '[', {word.format(2)})", f"concat({guard}, {told})"),
        (0, f"concat('${{', upper({word.format(1)}), '_', upper({word.format(2)}), '}}')", f"concat({strong}, {told})"),
        (0, f"concat('<', {plain.format(25)}, '-', {word.format(1)}, '>')", f"concat({strong}, {told})"),
        (0, "repeat(substr('*xX.#', cast(1 + pmod(id, 5) as int), 1), cast(6 + pmod(id, 9) as int))", f"concat({strong}, {told})"),
        (0, f"concat({chosen.format(21)}, if(id % 2 = 0, ' ', ''), {word.format(2)})", f"concat({prose}, {weak}, ': ')"),
        (0, f"concat({chosen.format(21)}, if(id % 2 = 0, {chosen.format(22)}, ''))", f"concat({prose}, {weak}, {told})"),
        (0, f"concat({word.format(1)}, ' ', {chosen.format(2)}, ' ', {word.format(3)}, ' ', {chosen.format(4)})", f"concat({weak}, ': \"')"),
        (0, "cast(1000000 + pmod(xxhash64(id), 90000000) as string)", f"concat({weak}, ': ')"),
        (0, f"substr({hexed}, 1, 40)", f"concat({harmless}, {sign})"),
        (0, f"substr({hexed}, 1, cast(16 + pmod(id, 40) as int))", prose),
        (0, f"regexp_replace({hexed}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}}).*$', '$1-$2-$3-$4-$5')", f"concat({harmless}, {sign})"),
        (0, "lpad(cast(pmod(xxhash64(id), 10000000000000000) as string), 16, '4')", f"concat({prose}, '+1 555 ')"),
        (0, f"concat({names}, '_', {word.format(9)})", f"concat({guard}, {sign})"),
        (0, f"concat({names}, '_', {word.format(9)})", prose),
        (0, f"concat('your-', {word.format(1)}, '-key-here-1234')", f"concat({guard}, {sign})"),
        (0, "concat(repeat(substr('xX0aA', cast(1 + pmod(id, 5) as int), 1), 20), '12')", f"concat({guard}, {sign})"),
    ]
    ids = spark.range(rows)
    case = lambda k: F.expr("case " + " ".join(f"when pmod(id, {len(kinds)}) = {i} then {x[k]}" for i, x in enumerate(kinds)) + " end")
    path = F.expr("case when pmod(xxhash64(id, 10), 10) = 0 then 'tests/example.py' else concat('src', pmod(id, 20)) end")
    return ids.select(case(1).alias("candidate"), case(2).alias("before"), F.when(F.col("id") % 3 == 0, '"').otherwise(" ").alias("after"), path.alias("path"), case(0).cast("double").alias("label"))


def features(findings: DataFrame) -> DataFrame:
    made = findings.withColumn("c", F.struct("candidate", "before", "after", "path"))
    return made.select("label", *[F.expr(f"cast({x} as double)").alias(n) for n, x in FEATURES.items()])


def train(findings: DataFrame, trees: int = 25, depth: int = 6, seed: int = 3) -> str:
    """A random forest over labelled findings as SQL over a struct ``f`` of features: the share of trees for secret."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(stored(features(findings), "findings"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows.select("features", "label"))
    votes = [_sql(iter(tree.toDebugString.splitlines()[1:])) for tree in forest.trees]
    return f"({' + '.join(votes)}) / {len(votes)}"


def _sql(lines) -> str:
    """One tree, printed in depth-first order, as a CASE expression.

    Without brackets: the parser looks for the end of each before it chooses a rule, and the driver keeps what it met.
    """
    line = next(lines).strip()
    if found := re.match(r"Predict: ([0-9.]+)", line):
        return found[1]
    feature, cut = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _sql(lines)
    next(lines)  # Else
    return f"case when f.{list(FEATURES)[int(feature)]} <= {float(cut)!r}D then {low} else {_sql(lines)} end"


def scan(docs: DataFrame, forest: str, text: str, path: str, cutoff: float, gaps: str, found: str) -> DataFrame:
    """``docs`` with two arrays: the ``gaps`` between candidates, and for each candidate in ``found`` its start
    (characters from 0), score and whether it is a secret."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    here = whole.rlike(CANDIDATE)
    cut = docs.withColumns({
        gaps: F.when(here, F.split(whole, CANDIDATE, -1)).otherwise(F.array(F.lit(""))),
        found: F.when(here, F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0))).otherwise(F.array().cast("array<string>")),
    })
    seen = F.expr(
        f"transform(`{found}`, (x, i) -> named_struct('candidate', x, 'before', right(`{gaps}`[i], {BESIDE}),"
        f" 'after', left(`{gaps}`[i + 1], {BESIDE}), 'path', coalesce(cast(`{path}` as string), ''), 'i', i))"
    )
    told = ", ".join(f"'{n}', cast({x} as double)" for n, x in FEATURES.items())
    rated = F.expr(f"transform(`{found}`, c -> named_struct('candidate', c.candidate, 'i', c.i, 'f', named_struct({told})))")
    inner = re.sub(r"\bf\.", "c.f.", forest)
    scored = F.expr(f"transform(`{found}`, c -> named_struct('candidate', c.candidate, 'i', c.i, 'score', cast({inner} as double)))")
    # Starts: lengths of all gaps up to the candidate's and of the candidates before it, added up along the array.
    starts = F.expr(
        f"aggregate(`{found}`, named_struct('at', cast(0 as bigint), 'all', array_repeat(cast(null as struct<candidate: string, start: bigint, score: double, secret: boolean>), 0)),"
        f" (a, c) -> named_struct('at', a.at + length(`{gaps}`[c.i]) + length(c.candidate), 'all', array_append(a.all, named_struct('candidate', c.candidate,"
        f" 'start', a.at + length(`{gaps}`[c.i]), 'score', c.score, 'secret', c.score >= {cutoff}))), a -> a.all)"
    )
    for step in (seen, rated, scored, starts):
        cut = cut.withColumn(found, step)
    return cut


def secrets(docs: DataFrame, findings: DataFrame | None = None, text: str = "text", id_col: str = "doc_id", path: str = "source", cutoff: float = 0.5) -> DataFrame:
    """A row for each candidate of each row of ``docs``: doc_id, start, n_chars, sha256 of the candidate, score, secret.

    NULL and empty texts have none.  A NULL path is an empty one; NULL ids are kept and repeated rows repeat their
    findings.  An empty table gives an empty one.  Secrets themselves are not part of the result.
    """
    forest = train(labelled_findings(docs.sparkSession) if findings is None else findings)
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{path}`").alias("path"))
    found = scan(own, forest, "text", "path", cutoff, "gaps", "found").select("doc_id", F.explode("found").alias("x"))
    return found.select(
        "doc_id", F.col("x.start").alias("start"), F.length("x.candidate").cast("bigint").alias("n_chars"),
        F.sha2(F.col("x.candidate").cast("binary"), 256).alias("candidate_sha256"), F.col("x.score").alias("score"), F.col("x.secret").alias("secret"),
    )


def mask_secrets(docs: DataFrame, findings: DataFrame | None = None, text: str = "text", path: str = "source", length: str | None = "n_chars", cutoff: float = 0.5) -> DataFrame:
    """``docs`` with ``MASK`` in place of each secret and, if there is such a column, the length of the new text; all
    rows and all other columns stay."""
    forest = train(labelled_findings(docs.sparkSession) if findings is None else findings)
    gaps, found = fresh_name(docs, "_gaps"), fresh_name(docs, "_found")
    cut = scan(docs, forest, text, path, cutoff, gaps, found)
    any_secret = F.expr(f"exists(`{found}`, c -> c.secret)")
    masked = F.expr(
        f"concat(`{gaps}`[0], array_join(transform(`{found}`, (c, i) -> concat(if(c.secret, '{MASK}', c.candidate), `{gaps}`[i + 1])), ''))"
    )
    new = {text: F.when(any_secret, masked).otherwise(F.col(f"`{text}`"))}
    if length and length in docs.columns:
        new[length] = F.when(any_secret, F.length(masked).cast(docs.schema[length].dataType)).otherwise(F.col(f"`{length}`"))
    return cut.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])
