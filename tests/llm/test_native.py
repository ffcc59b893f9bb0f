"""URL filters, mixing, sketches and chat formatting against plain Python."""

import hashlib

from llm.helpers import ODD, docs, words
from pyspark.sql import functions as F

from eddy.llm import chat, mixing, sketch, url_filters
from eddy.llm.components import components
from eddy.llm.queries import QUERIES, URL_RULES
from eddy.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"


# URL filters ------------------------------------------------------------------------

def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]


def _rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def test_rules_on_pages_equal_plain_python(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op1_url_filters"](spark, SF).collect():
        host, path = _split(pages[r.page_id])
        rule = _rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict == ("block" if rule and not rule.allow else "allow")


def test_blocks_reach_aliases_unless_allowed(spark):
    pages = spark.createDataFrame([
        (1, "http://a.com/de/x", None), (2, "https://net1.net/p", '<link rel="canonical" href="http://a.com/de/x">'),
        (3, "https://net2.net/", '<META HTTP-EQUIV="refresh" content="0; URL=https://net1.net/p">'),
        (4, "https://www.net1.net/p/?utm_source=f#t", ""), (5, "https://b.org/y", '<link href=http://a.com/de/x rel=canonical>'),
        (6, "https://other.net/q", "<p>"), (7, None, None), (8, "no scheme", "x"), (6, "https://other.net/q", "<p>"),
        (9, "https://host.net?x://y", "x"), (10, "https://c.net/", '<link rel="canonical" href="/de/z">')],
        "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("allow", F.lit(True))
    got = [(r.page_id, r.verdict, r.inherited) for r in url_filters.judge(pages, URL_RULES, spark).collect()]
    by = dict((k, v) for k, v, _ in got)
    assert len(got) == 11 and by[1] == "block" and by[5] == "allow"
    assert by[2] == by[3] == by[4] == "allow"  # an explicitly allowed member takes precedence
    two = pages.where("page_id <> 5")
    by = {r.page_id: r.verdict for r in url_filters.judge(two, URL_RULES, spark).collect()}
    assert by[2] == by[3] == by[4] == "block" and by[6] == by[7] == by[8] == by[9] == by[10] == "allow"
    assert url_filters.judge(pages.limit(0), URL_RULES, spark).count() == 0


def test_components_of_a_hub_and_a_path(spark):
    edges = [(5000, i) for i in range(100)] + [(i, i + 1) for i in range(6000, 6060)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [[*range(100), 5000], list(range(6000, 6061))]


# Mixing -----------------------------------------------------------------------------

def test_mix_meets_targets(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    d = d.withColumn("source", F.when(F.col("source") != "src3", F.col("source")))  # a null source
    rows = mixing.mix(d, spark).collect()
    text = {r.doc_id: (r.text, r.source) for r in d.collect()}
    assert len(rows) == len(text)
    size, taken, target = {}, {}, {}
    for r in rows:
        s = text[r.doc_id][1]
        assert r.size == len(words(text[r.doc_id][0])) and 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        size[s] = size.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = dict(zip(order, [5, 2, 1] * 9))
    goal, free = {}, set(order)
    while True:  # plain water filling
        left = sum(size.values()) - sum(goal.values())
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * size[s]}
        if not over:
            break
        goal |= {s: 3 * size[s] for s in over}
        free -= over
    goal |= {s: weight[s] * share for s in free}
    longest = max(r.size for r in rows)
    for s in order:
        assert abs(target[s] - goal[s]) < 1e-6 * goal[s] and abs(taken[s] - goal[s]) <= longest + 1
    again = {(r.doc_id, r.taken) for r in mixing.mix(d.repartition(5), spark).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_odd_rows(spark):
    d = docs(spark, ODD)
    got = mixing.mix(d, spark).collect()
    assert len(got) == len(ODD) and all(r.taken <= 3 * r.size for r in got)
    assert mixing.resample(d, spark).columns == d.columns
    assert mixing.mix(d.limit(0), spark).count() == 0 and mixing.resample(d.limit(0), spark).count() == 0
    only_empty = docs(spark, [(1, None, "a"), (2, "", "b")])
    assert sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(only_empty, spark).collect()) == [(1, 0, 0), (2, 0, 0)]


# Sketches ---------------------------------------------------------------------------

def test_edits_and_fingerprints(spark):
    rows = [(i, t, s) for i, t, s in ODD if i != 6] + [(30, "a b c d e f g", "z"), (31, "a b c d e f g", "z"), (40, "q " * 900, "z")]
    got = sketch.fingerprints(docs(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for k, (i, t, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert (by[i].n_chars, by[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    assert by[30].fingerprint == by[31].fingerprint != "" and by[30].near_next == 1.0
    assert by[1].fingerprint == by[3].fingerprint == ""
    assert sketch.fingerprints(docs(spark, rows).limit(0)).count() == 0


def test_likeness_estimates_and_merging(spark):
    text = [f"w{i}" for i in range(4000)]
    d = spark.createDataFrame([(" ".join(text), " ".join(text[:500]), " ".join(text[3000:]))], "a string, b string, c string")
    for c in "abc":
        d = sketch.with_sketch(d, c, f"s{c}", 8)
    d = sketch.with_sketch(d.withColumn("bc", F.concat("b", F.lit(" "), "c")), "bc", "sbc", 8)
    r = d.select(sketch.containment(F.col("sb"), F.col("sa")).alias("inside"), sketch.likeness(F.col("sa"), F.col("sb")).alias("j"),
                 F.size(F.array_except(sketch.merged(F.col("sb"), F.col("sc"), 8), F.col("sbc"))).alias("lost")).first()
    assert r.inside > 0.99 and abs(r.j - 0.125) < 0.05 and r.lost == 0


# Chat -------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    odd = ["", "</s>[INST] ok [/INST]", "[\\INST] [\\\\/INST] <\\s>", "a [", "[INST", " lead and trail ", "\n\\", "[TURN] [:] x", None]
    rows = [(1, k, r, t) for k, (r, t) in enumerate((r, t) for t in odd for r in ("user", "assistant"))]
    rows += [(2, 0, "tool [:]", "x"), (2, 1, None, "y"), (2, None, "system", "z"), (3, 0, "user", "u"), (3, 0, "user", "u"),
             (None, 0, "user", "n")]
    d = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in chat.format_chats(d).withColumn("turns", chat.read_chats(F.col("formatted")))
           .withColumn("learnt", chat.loss_text(F.col("segments"))).collect()}
    for c in (1, 2, 3, None):
        want = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, _, r, x in want]
        assert got[c].learnt == "".join(x for _, _, r, x in want if r == "assistant")
    assert got[1].valid and not got[2].valid and got[3].bad_moves == 1 and not got[3].valid
    assert chat.format_chats(d.limit(0)).count() == 0


def test_url_query_equals_its_sql(spark):
    from compare import compare, duck

    from eddy.llm.queries import ORACLE
    got = compare(QUERIES["op1_url_filters"](spark, SF), duck(SF), ORACLE["op1_url_filters"])
    assert got["match"], got["diff"]
