"""Personal data: strict patterns against plain ones, contexts, masking."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from termfold.llm import pii
from tests.llm.messy import check_shapes, empty

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a@b.c", ".", "@", "1", "22", "333", "255", "4", "-", " ", "+1", "(", ")", "x", "é", "🙂", "4111 1111 1111 1111",
         "4111-1111-1111-1111", "_", "12.1.1.1", "a.b", "+49 30 123456", "000", "\n", "1 2"]


def holds(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if holds(k, m.group()))
    return [(k, a, b) for a, _, b, k in found]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(df, texts):
    for r in pii.extract(df).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), texts[r.doc_id]
        assert set(listed(want).split(",")) <= set(r.spans.split(",")) or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in PLAIN]


def test_base_spans_equal_plain_patterns(spark):
    r = random.Random(5)
    texts = dict(enumerate("".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(1500)))
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8), texts)


def test_query_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, {r.doc_id: r.text for r in docs.collect()})


def test_long_runs_take_linear_time(spark):
    texts = dict(enumerate(["a@" * 100_000, "1" * 200_000, "1.2.3.4 " * 5_000, "+1" * 50_000, "a" * 300_000, "x@y.zz " * 5_000, "1 " * 100_000]))
    got = {r.doc_id: r for r in pii.extract(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)).collect()}
    assert got[2].n_ip == 5_000 and got[5].n_email == 5_000 and [got[i].spans for i in (0, 1, 3, 4, 6)] == [""] * 5


CONTEXT = [(i, f"Call tel: +1 (988) 555-24{i:02d} now") for i in range(10)] + [
    (50, "tel: (555) 123-4567 ok"), (51, "the (555) 123-4567x"), (52, None), (53, "see 555-123-9999"), (54, "the tel: number")]


def test_contexts_discover_what_patterns_miss(spark):
    docs = spark.createDataFrame(CONTEXT, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert (got[50].spans, got[50].n_added, got[50].n_phone) == ("phone:5:19", 1, 0)
    assert [got[i].spans for i in (51, 52, 53, 54)] == [""] * 4
    text = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert (text[3], text[50], text[52], text[53]) == ("Call tel: [PHONE] now", "tel: [PHONE] ok", None, "see 555-123-9999")


def test_accepted_candidates_bring_in_their_own_patterns(spark):
    """Seeds stand beside one context, the first candidates beside two, the last beside the second only."""
    docs = [(i, f"Call tel: +1 (988) 555-24{i:02d} now") for i in range(20)]
    docs += [(100 + i, f"tel: (555) 123-45{i:02d} or mobile (555) 123-45{i:02d} today") for i in range(4)]
    docs += [(200, "my mobile (555) 987-6543 is new"), (201, "my shop (555) 987-0000 is new")]
    got = {r.doc_id: r for r in pii.extract(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got[100].n_added == 2 and got[200].spans == "phone:10:24" and got[201].spans == ""


def test_glued_labels_and_trailing_punctuation(spark):
    """Contexts are counted as they are taken: glued labels are found, a comma behind a number tells nothing."""
    docs = [(i, f"Call tel:+1 (988) 555-24{i:02d}, then wait, or go, or stay") for i in range(20)]
    docs += [(50, "tel:(555) 123-4567 ok"), (51, "see 555-123-9999, or not"), (52, "mix1(555) 123-4567 , 1")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.extract(df).collect()}
    assert (got[50].spans, got[51].spans) == ("phone:4:18", "")
    found = pii.accepted(df, pii.scanned(df, ["doc_id"]))
    assert [(r.kind, r.value) for r in found.collect()] == [(3, "(555) 123-4567")]


def test_pattern_occurrences_are_never_fewer_than_those_beside_spans(spark):
    r = random.Random(9)
    texts = ["".join(r.choice([*PARTS, "tel:", ", ", "ip=", "É", "_"]) for _ in range(r.randint(0, 25))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    beside = pii.scanned(docs, []).select(F.explode("_base").alias("s")).select(*pii._lexical("s", 1)).groupBy("kind", "pattern").count()
    beside, size = pii.staged_and_measured(beside)
    totals = pii._occurrences(docs, beside.select("pattern").distinct(), size)
    rows = beside.join(totals, "pattern", "left").collect()
    assert len(rows) > 300 and all(x["total"] is not None and x["count"] <= x["total"] for x in rows)


SEEDS = {"phone": "+1 (988) 555-24{:02d}", "ip": "10.0.0.{}", "email": "n{}@host.org", "card": "4111 1111 1111 1111"}
PROPOSED = {
    "phone": ["5551234567", "555 123 45 67"], "ip": ["fe80::1", "10[.]0[.]0[.]7"], "email": ["name at host dot com", "j [at] x.org", "me @ x.org"],
    "card": ["4111_1111_1111_1111", "4111 / 1111 / 1111 / 1111"],
}


def test_confident_patterns_propose_what_no_form_lists(spark):
    seeds = {k: [v.format(i) for i in range(12)] for k, v in SEEDS.items()}
    seeds["card"] = ["4111 1111 1111 1111", "5500-0000-0000-0004", "3400 0000 0000 009", "6011000000000004"] * 3
    docs = [(100 * k + i, f"My {kind} is: {v} thanks") for k, kind in enumerate(seeds) for i, v in enumerate(seeds[kind])]
    want, clean = {}, ["build 5551234567 done", "at 12:30:45 sharp", "look at amazon.com now", "My phone is: off", "std::vector x", "lot 4111_1111_1111_1111_2"]
    for k, kind in enumerate(PROPOSED):
        for i, v in enumerate(PROPOSED[kind]):
            text = f"x My {kind} is: {v} thanks"
            docs.append((1000 + 10 * k + i, text))
            want[1000 + 10 * k + i] = f"{kind}:{text.index(v)}:{text.index(v) + len(v)}"
    docs += [(2000 + i, t.replace("5551234567", "5550000000")) for i, t in enumerate(clean)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.extract(df).collect()}
    assert {i: got[i].spans for i in want} == want
    assert [got[2000 + i].spans for i in range(len(clean))] == [""] * len(clean)
    text = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert text[1000] == "x My phone is: [PHONE] thanks" and text[2000] == "build 5550000000 done"


def test_overlapping_spans_are_masked_once(spark):
    df = spark.createDataFrame([(1, "a +4111111111111111 b x@y.zz"), (2, "é🙂 1.2.3.4, 1.2.3.4")], "doc_id long, text string")
    text = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert "4111" not in text[1] and text[1].endswith(" b [EMAIL]") and text[2] == "é🙂 [IP], [IP]"


def test_odd_rows(spark):
    got = check_shapes(spark, pii.extract, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    assert all(r.spans == "" for r in got.values())
    assert pii.masked(empty(spark)).collect() == []


def test_running_sums(spark):
    df = spark.createDataFrame([(list(range(1, n + 1)),) for n in (1, 2, 3, 7, 100)], "v array<int>")
    for r in df.select("v", pii.let(F.col("v"), pii._running).alias("s")).collect():
        assert r.s == [sum(r.v[: i + 1]) for i in range(len(r.v))]


def graph_plainly(texts):
    """Values that the graph accepts, with dictionaries; spans and contexts by the operator's own forms."""
    import math
    from collections import Counter, defaultdict

    word = r"[^\W_]|_"                                            # tests hold plain letters and digits only
    token = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
    counts, edges = Counter(), defaultdict(Counter)
    for text, spans in texts:
        tokens = token.findall(text)
        for k in (1, 2, 3):
            counts.update(" ".join(tokens[i : i + k]).lower() for i in range(len(tokens) - k + 1))
        for start, end, kind, seed, others in spans:
            left = max([0, *(e for s, e in others if e <= start)])
            right = min([len(text), *(s for s, e in others if s >= end)])
            before = [m for m in token.finditer(text, 0, start)]
            before = [text[m.start() : m.end()] for m in before if m.start() >= left and not (m.start() == left and left and text[left - 1].isalnum() and text[left].isalnum())]
            after = token.match(text[end:right].lstrip())
            patterns = []
            if not (start and text[start - 1].isalnum() and text[start].isalnum()):
                patterns += [f"L{k} " + " ".join(before[-k:]).lower() for k in (1, 2, 3) if len(before) >= k]
            if after and not (text[end - 1].isalnum() and text[end : end + 1].isalnum()):
                cut = right < len(text) and after.end() == len(text[end:right].lstrip()) and text[right].isalnum() and after.group()[-1].isalnum()
                patterns += [] if cut else ["R1 " + after.group().lower()]
            for p in patterns:
                edges[kind, text[start:end], seed][p] += 1
    good = {(k, v) for k, v, seed in edges if seed == 1}
    found = set()
    while True:
        beside, support = Counter(), defaultdict(set)
        for (k, v, _), ps in edges.items():
            if (k, v) in good:
                for p, n in ps.items():
                    beside[k, p] += n
                    support[k, p].add(v)
        confidence = {kp: min(0.99, n / counts[kp[1][3:]]) for kp, n in beside.items() if len(support[kp]) >= pii.SUPPORT}
        new = set()
        for k, v in {(k, v) for k, v, seed in edges if seed <= 0}:
            own = {p for (a, b, s), ps in edges.items() if (a, b) == (k, v) and s <= 0 for p in ps}
            got = [confidence[k, p] for p in own if (k, p) in confidence]
            best_seed = max(s for (a, b, s) in edges if (a, b) == (k, v) and s <= 0)
            if got and (best_seed > -1 or max(got) >= pii.PROPOSE) and 1 - math.prod(1 - c for c in got) >= pii.ACCEPT:
                new.add((k, v))
        if len(new) == len(found):
            return found
        found, good = new, good | new


def chain(labels, each=4, often=5):
    """Numbers once beside one label and often beside the next, and so on: each label is learned from the one before."""
    texts = [f"tel +1 988 555 24{i:02d} now" for i in range(each) for _ in range(often)]
    names = ["tel", *labels]
    for n, (a, b) in enumerate(zip(names, names[1:])):
        for i in range(each):
            number = f"(98{n}) 555-24{i:02d}"
            texts += [f"{a} {number}", *[f"{b} {number}"] * often]
    return texts


def found_numbers(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in pii.extract(docs).collect() if r.spans}


def test_the_bootstrap_goes_on_until_it_settles(spark):
    texts = chain(["alpha", "bravo", "carol", "delta", "eagle"])
    assert found_numbers(spark, texts) == set(range(len(texts)))


@pytest.mark.parametrize("label", ["l" * 13, "l" * 60, "long " + "w" * 70 + " label", "l" * 5000])
def test_labels_of_any_length(spark, label):
    texts = [f"see {label} +1 988 555 24{i:02d} now" for i in range(6)] + [f"see {label} (988) 555-24{i:02d} there" for i in range(4)]
    assert found_numbers(spark, texts) == set(range(10))


def test_local_parts_of_any_length(spark):
    local = "x" * 300
    texts = [f"mail {local}{i}@host.org now" for i in range(6)] + [f"mail {local}{i} (at) host.org now" for i in range(4)]
    assert found_numbers(spark, texts) == set(range(10))


def test_graph_equals_a_plain_version(spark):
    """Scores of patterns and instances in many small tables at once, told apart by a word in every label."""
    import random

    r = random.Random(8)
    for _ in range(3):
        labels = [f"lab{i}" for i in range(5)]
        texts = []
        for i in range(60):
            number = f"555-24{r.randrange(12):02d}"
            form = r.choice(["+1 988 {}", "(988) {}", "(988) {}", "988.{}"]).format(number if r.random() < 0.9 else "555-9999")
            texts.append(f"{r.choice(['', 'call '])}{r.choice(labels)}{r.choice([' ', ': '])}{form}{r.choice(['', ' now', ', ok'])}" if r.random() < 0.85 else f"{r.choice(labels)} {r.choice(['now', 'alone'])}")
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        scan = pii.staged(pii.scanned(docs, ["doc_id"]))
        rows = scan.collect()
        plainly = []
        for row in rows:
            by_seed = [(1, row._base), (0, row._loose), (-1, row._weak)]
            # contexts end at the next match of the same kind and form
            spans = [(s.start, s.end, s.kind, seed, [(o.start, o.end) for o in group if o.kind == s.kind and o.start != s.start]) for seed, group in by_seed for s in group]
            plainly.append((texts[row.doc_id], spans))
        got = pii.accepted(docs, scan)
        assert (set() if got is None else {(r.kind, r.value) for r in got.collect()}) == graph_plainly(plainly)
