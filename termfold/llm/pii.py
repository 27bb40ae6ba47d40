"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are the matches of four strict patterns (email, ip, card, phone). Tokens are runs of letters and digits, and
single other characters. The tokens around a seed are its lexical patterns: the one, two and three tokens before, the
token after. A token that the match cuts is none. Further strings of looser forms (addresses with
"(at)", numbers without a plus, six-part addresses, dotted card numbers) are candidates, with the same kinds of
lexical patterns around them. So is what a pattern with a confidence of PROPOSE or more proposes: the run beside it, if
it has any shape of its kind (7 to 15 or 12 to 19 digits however split, colons between hex digits, "at" or "@" with a
host; a bare "at" needs a dot as well). In the graph of lexical patterns and instances scores are computed in turn:

    confidence of a pattern  = occurrences beside accepted instances / its occurrences in all texts, as the same tokens
    score of an instance     = 1 - product over its patterns of (1 - confidence)

Patterns count from SUPPORT different accepted instances on. Candidates that score ACCEPT or more are accepted and
lend their support in the next round, until a round accepts no more. The occurrences of all patterns that may ever
count are taken in one scan. All occurrences of an accepted instance are added to the spans; base spans stay.

Positions are counted in code points, the end is exclusive. They follow from the lengths of the pieces between
matches. The patterns are equal to the plain ones given in the comments, but never go back over a text: runs are
possessive and a match starts only where a run does, so a text of any length takes linear time.

Defined results: null text is empty and has no spans; equal texts have equal spans; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.llm.shared import table
from termfold.operators.staging import Size, staged, staged_and_measured

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ with 12 to 19 digits
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{2,}}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9./])[0-9]{4}(?:[./][0-9]{4}){2,3}(?![0-9./])",
    "phone": r"(?<![0-9A-Za-z.+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
}
#: Any shape of a kind: candidates only where a pattern proposes them.
_OPEN, _SHUT = r"\x20?[\[({<]\x20?", r"\x20?[\])}>]\x20?"
_HOST, _DOT = "[A-Za-z0-9-]++", rf"(?:\.|{_OPEN}(?:dot|DOT|\.){_SHUT}|\x20(?:dot|DOT)\x20)"
_RUN = "(?<![0-9A-Za-z+])(?<![0-9][{all}]{{1,3}}){first}[0-9](?:(?:[{tight}]{{0,3}}[0-9]){{{n}}}+(?![{tight}]{{0,3}}[0-9]|[A-Za-z])|(?:[{all}]{{0,3}}[0-9]){{{n}}}+(?![{all}]{{0,3}}[0-9]|[A-Za-z]))"
WEAK = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:(?:{_OPEN}(?:at|AT|@){_SHUT}|\x20?@\x20?){_HOST}(?:{_DOT}{_HOST})*+|\x20(?:at|AT)\x20{_HOST}(?:{_DOT}{_HOST})++)",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?=:*[0-9A-Fa-f])(?:[0-9A-Fa-f]*+:){2,}+[0-9A-Fa-f]*+(?:\.[0-9]++){0,3}+(?![0-9A-Za-z:])"
          r"|[0-9]{1,3}+(?:(?:\x20?[\[(](?:\.|dot|DOT)[\])]\x20?|\x20(?:dot|DOT|\.)\x20|[,_-])[0-9]{1,3}+){3}(?![0-9A-Za-z]))",
    "card": _RUN.format(all=r"\x20./_,-", tight="./_,-", first="", n="11,18"),
    "phone": _RUN.format(all=r"\x20()./-", tight="()./-", first="[+(]?", n="6,14"),
}
#: What a text must hold to be searched at all: a cheap test that most texts fail.
GATES = {
    # strict, loose
    ("email", True): "@", ("ip", True): r"[0-9]\.[0-9]", ("card", True): r"[0-9][\x20-]?[0-9]", ("phone", True): r"\+[0-9]",
    ("email", False): r"[\[(](?:at|AT)[\])]", ("ip", False): r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:",
    ("card", False): r"[0-9]{4}[./][0-9]{4}", ("phone", False): r"[0-9]{3}[.-][0-9]{4}",
}
WEAK_GATES = {
    "email": r"@|[\x20\[({<](?:at|AT)[\x20\])}>]", "ip": r":[0-9A-Fa-f]*+:|[0-9](?:\x20?[\[(]|\x20(?:dot|DOT|\.)|[,_-])",
    "card": r"[0-9](?:[\x20./_,-]{0,3}[0-9]){11}", "phone": r"[0-9](?:[\x20()./-]{0,3}[0-9]){6}",
}
#: Characters of words, and tokens: words and single other characters.
_WORD = r"[\p{L}\p{M}\p{N}]"
TOKEN = rf"{_WORD}++|[^\s\p{{L}}\p{{M}}\p{{N}}]"
#: What is kept of the text beside a match: three tokens (backwards), or one, however long, and the character beyond.
_BACK = rf"(?s)^(?:\s*+(?:{TOKEN})){{0,3}}+\s*+.?"
_ON = rf"(?s)^\s*+(?:{TOKEN})?+.?"
SUPPORT, ACCEPT = 3, 0.8
PROPOSE = 0.5
#: Marks weak spans in place of 1 for seeds and 0 for loose spans.
WEAK_SEED = -1
MASK = "[{}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """Sums of an array (a value, not an expression) up to each element, in steps of about the root of its size."""
    def summed(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def blocks(n: Column, width: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), ((n - 1) / width).cast("int")), lambda b: summed(F.slice(lengths, b * width + 1, width)))
        return let(sums, lambda s: let(
            F.transform(s, lambda _, b: summed(F.slice(s, F.lit(1), b))),
            lambda before: F.transform(lengths, lambda _, i: let((i / width).cast("int"), lambda b: F.get(before, b) + summed(F.slice(lengths, b * width + 1, i - b * width + 1)))),
        ))

    return let(F.size(lengths), lambda n: let(F.ceil(F.sqrt(n)).cast("int"), lambda width: blocks(n, width)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits end in their check digit."""
    doubled = let(F.reverse(F.split(digits, "")), lambda d: F.transform(d, lambda x, i: let(
        x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v))))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[1-9]|)(?:\.|$)){4}$")
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


_SPAN = "array<struct<start:int,kind:int,end:int,value:string,before:string,after:string>>"


def _found(text: Column, kind: str, pattern: str, gate: str, check: bool) -> Column:
    """Matches of one kind with their places and the text around them."""
    number = KINDS.index(kind)

    def edge(m: Column, i: Column, end: Callable) -> Column:
        # the nearest character of the match beside a piece shows whether a word goes on there
        return F.coalesce(end(F.get(m, i), F.lit(1)), F.lit(" "))

    def placed(m: Column, p: Column) -> Column:
        # a piece and the match after it
        steps = F.zip_with(F.slice(p, F.lit(1), F.size(m)), m, lambda a, b: F.length(a) + F.length(b))
        return let(steps, lambda lengths: let(_running(lengths), lambda ends: F.transform(m, lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).cast("int").alias("start"), F.lit(number).alias("kind"), F.get(ends, i).cast("int").alias("end"),
            v.alias("value"), F.reverse(F.regexp_extract(F.reverse(F.concat(edge(m, i - 1, F.right), F.get(p, i))), _BACK, 0)).alias("before"),
            F.regexp_extract(F.concat(F.get(p, i + 1), edge(m, i + 1, F.left)), _ON, 0).alias("after")))))

    every = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(
        F.size(m) > 0, let(F.split(text, pattern, -1), lambda p: placed(m, p)).cast(_SPAN)).otherwise(F.array().cast(_SPAN)))
    every = F.when(text.rlike(gate), every).otherwise(F.array().cast(_SPAN))
    return F.filter(every, lambda s: _valid(kind, s["value"])) if check else every


def base_spans(text: Column) -> Column:
    """Spans of the strict patterns, by start, then kind."""
    return F.array_sort(reduce(F.concat, [_found(text, k, BASE[k], GATES[k, True], True) for k in KINDS]))


def loose_spans(text: Column) -> Column:
    return F.array_sort(reduce(F.concat, [_found(text, k, LOOSE[k], GATES[k, False], False) for k in KINDS]))


def weak_spans(text: Column) -> Column:
    return F.array_sort(reduce(F.concat, [_found(text, k, WEAK[k], WEAK_GATES[k], False) for k in KINDS]))


def _apart(loose: Column, base: Column, same: bool = False) -> Column:
    """Those that touch no base span, or none of the same kind."""
    def touch(b: Column, c: Column) -> Column:
        over = (b["start"] < c["end"]) & (c["start"] < b["end"])
        return over & (b["kind"] == c["kind"]) if same else over

    return F.filter(loose, lambda c: ~F.exists(base, lambda b: touch(b, c)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the text's hash, base spans, loose spans and weak spans of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(*keep, F.md5(text).alias("_hash"), base_spans(text).alias("_base"), loose_spans(text).alias("_loose"), weak_spans(text).alias("_weak"))
        .withColumn("_loose", _apart(F.col("_loose"), F.col("_base")))
        .withColumn("_weak", _apart(_apart(F.col("_weak"), F.col("_base")), F.col("_loose"), same=True))
    )


def _lexical(spans: str, seed: int) -> list[Column]:
    """Kind, instance and lexical patterns of each span of an array column."""
    def tokens(side: str, cut: str) -> Column:
        # a word at the very end is cut, by the next match or by what is kept
        return F.transform(F.regexp_extract_all(F.regexp_replace(side, cut, ""), F.lit(TOKEN), F.lit(0)), F.lower)

    def whole(left: str, right: str) -> Column:
        return ~(F.col(left).rlike(rf"{_WORD}$") & F.col(right).rlike(rf"^{_WORD}"))

    before, after = tokens("s.before", rf"^{_WORD}++"), tokens("s.after", rf"{_WORD}++$")
    last = [F.reverse(F.slice(F.reverse(before), 1, k)) for k in (1, 2, 3)]
    lefts = [F.when(F.size(w) == k, F.concat(F.lit(f"L{k} "), F.concat_ws(" ", w))) for k, w in enumerate(last, 1)]
    patterns = F.concat(
        F.when(whole("s.before", "s.value"), F.array(*lefts)).otherwise(F.array().cast("array<string>")),
        F.array(F.when(whole("s.value", "s.after"), F.concat(F.lit("R1 "), F.get(after, F.lit(0))))),
    )
    return [F.col("s.kind").alias("kind"), F.col("s.value").alias("value"), F.lit(seed).alias("seed"), F.explode(F.array_compact(patterns)).alias("pattern")]


def _occurrences(docs: DataFrame, patterns: DataFrame, size: Size) -> DataFrame:
    """How often each lexical pattern occurs in all texts, whatever it stands beside."""
    asked = patterns.select("pattern", F.substring("pattern", 4, 1 << 20).alias("run"))
    tokens = docs.select(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(TOKEN), F.lit(0)).alias("w"))
    each = tokens.select(F.explode(F.arrays_zip(F.col("w").alias("a"), _from(2).alias("b"), _from(3).alias("c"))).alias("x"))
    two = F.concat("x.a", F.lit(" "), F.col("x.b"))
    runs = each.select(F.explode(F.array_compact(F.array(F.col("x.a"), two, F.concat(two, F.lit(" "), F.col("x.c"))))).alias("run")).select(F.lower("run").alias("run"))
    runs = runs.join(F.broadcast(asked.select("run").distinct()) if size.broadcastable else asked.select("run").distinct(), "run", "left_semi")
    return asked.join(runs.groupBy("run").agg(F.count(F.lit(1)).alias("total")), "run").select("pattern", "total")


def _from(k: int) -> Column:
    return F.slice(F.col("w"), F.lit(k), F.greatest(F.size("w"), F.lit(1)))


def accepted(docs: DataFrame, scan: DataFrame) -> DataFrame | None:
    """Kind and value of the candidates that the graph accepts; None if there is no candidate with a common pattern."""
    loose = scan.select(F.explode("_loose").alias("s")).select(*_lexical("s", 0))
    loose = loose.unionByName(scan.select(F.explode("_weak").alias("s")).select(*_lexical("s", WEAK_SEED)))
    candidates = staged(loose.groupBy("kind", "value", "seed", "pattern").agg(F.count(F.lit(1)).alias("n")))
    if candidates.isEmpty():
        return None
    # only patterns that stand beside a candidate can tell something
    asked = candidates.select("kind", "pattern").distinct()
    seeds = (
        scan.select(F.explode("_base").alias("s")).select(*_lexical("s", 1))
        .join(asked, ["kind", "pattern"], "left_semi")
        .groupBy("kind", "value", "seed", "pattern").agg(F.count(F.lit(1)).alias("n"))
    )
    edges = candidates.unionByName(seeds)
    # instances only become accepted: what lacks support among all of them will never count
    able = staged(edges.groupBy("kind", "pattern").agg(
        F.count_distinct("value").alias("_all"), F.count_distinct(F.when(F.col("seed") == 1, F.col("value"))).alias("_seeds")
    ).where(F.col("_all") >= SUPPORT))
    if able.where(F.col("_seeds") >= SUPPORT).isEmpty():
        return None
    edges = staged(edges.join(able.select("kind", "pattern"), ["kind", "pattern"], "left_semi"))
    asked, size = staged_and_measured(able.select("pattern").distinct())
    totals = staged(_occurrences(docs, asked, size))
    first = staged(edges.where("seed = 1").select("kind", "value").distinct())
    open_ = staged(edges.where("seed <= 0").groupBy("kind", "value", "pattern").agg(F.max("seed").alias("seed")))
    good, n_found = first, 0
    while True:
        beside = (
            edges.join(good, ["kind", "value"], "left_semi").groupBy("kind", "pattern")
            .agg(F.sum("n").alias("_n"), F.count_distinct("value").alias("support")).where(F.col("support") >= SUPPORT)
        )
        confidence, size = staged_and_measured(beside.join(totals, "pattern").select("kind", "pattern", F.least(F.lit(0.99), F.col("_n") / F.col("total")).alias("confidence")))
        confidence = F.broadcast(confidence) if size.broadcastable else confidence
        scores = (
            open_.join(confidence, ["kind", "pattern"]).groupBy("kind", "value")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"), F.max("seed").alias("seed"), F.max("confidence").alias("best"))
        )
        candidate = (F.col("seed") > WEAK_SEED) | (F.col("best") >= PROPOSE)
        found, size = staged_and_measured(scores.where(candidate & (F.col("score") >= ACCEPT)).select("kind", "value"))
        # more support only raises confidences: none is lost again, and the same number is the same set
        if size.rows == n_found:
            return found
        good, n_found = first.union(found).distinct(), size.rows


def _added(scan: DataFrame, found: DataFrame) -> DataFrame:
    """Hash of a text and its accepted spans."""
    return staged(
        scan.select("_hash", F.explode(F.concat("_loose", "_weak")).alias("s")).select("_hash", "s", "s.kind", "s.value")
        .join(found, ["kind", "value"], "left_semi").groupBy(F.col("_hash").alias("_of")).agg(F.collect_set("s").alias("_more"))
    )


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (base and added) and n_added of each document."""
    scan = staged(scanned(docs, ["doc_id"]))
    found = accepted(docs, scan)
    every, more = scan, F.array().cast(_SPAN)
    if found is not None:
        every = scan.join(_added(scan, found), F.col("_hash") == F.col("_of"), "left")
        more = F.coalesce(F.col("_more"), F.array().cast(_SPAN))
    counts = [_count(F.col("_base"), i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return every.select(
        "doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat(F.col("_base"), more))).alias("spans"), F.size(more).cast("long").alias("n_added"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with a placeholder for each run of overlapping spans, named by the first."""
    marks = F.array(*[F.lit(MASK.format(k.upper())) for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(marks, s["kind"])))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), new.alias("parts"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts")))

    return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by placeholders in ``text``; null texts stay null."""
    scan = staged(scanned(docs, []).where((F.size("_base") > 0) | (F.size("_loose") > 0) | (F.size("_weak") > 0)))
    found = accepted(docs, scan)
    spans, rows = base_spans(F.col("text")), docs
    if found is not None:
        rows = docs.join(_added(scan, found), F.md5("text") == F.col("_of"), "left")
        spans = F.array_sort(F.concat(spans, F.coalesce(F.col("_more"), F.array().cast(_SPAN))))
    text = let(spans, lambda s: F.when(F.size(s) == 0, F.col("text")).otherwise(_masked(F.col("text"), s)))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents"))
