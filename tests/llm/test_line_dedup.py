import random
import re

from pyspark.sql import functions as F

from segmark.llm import line_dedup
from segmark.llm.line_dedup import dedup_lines, line_components, shingles
from tests.llm.cases import DOCS, docs, edge_docs, empty_docs, sentence

SHINGLES = re.compile(r"(?s)(?=(.{1,9}))\S{1,8}\s*")


def normal(line):
    return line.lower().strip(" \t\r\x0b\x0c")


def brute(texts, similarity=0.8):
    """Text of each document after exact all-pairs comparison, and the number of links."""
    first = {}
    for i, t in enumerate(texts):
        for k, line in enumerate(t.split("\n") if t is not None else []):
            if normal(line):
                first.setdefault(normal(line), (i, k))
    sets = {n: set(SHINGLES.findall(n)) for n in first}
    parent = {n: n for n in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names, links = list(first), []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = len(sets[a] & sets[b])
            if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
                parent[find(a)] = find(b)
    keep = {}
    for n, place in first.items():
        keep[find(n)] = min(keep.get(find(n), (1 << 60, 0)), place)
    stay = set(keep.values())
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not normal(x) or (i, k) in stay)
            for i, t in enumerate(texts)], links


def planted(seed=3):
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in (60, 45, 30, 20, 12)]
    texts = []
    for i in range(60):
        lines = [sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5))]
        for line in rng.sample(base, 2):
            words = line.split()
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice(["quxo", "zorp", "blam"])
            lines.insert(rng.randrange(len(lines) + 1), " ".join(words) if rng.random() < 0.8 else "  " + line.upper() + " ")
        texts.append("\n".join(lines + [""] * rng.randint(0, 2)))
    return texts + ["", None, "\n \n", base[0] + "\n" + base[0], "Q\nq\n Q \nq.", "x" * 4000, "x" * 4000 + "y"]


def test_links_have_high_recall_and_no_false_member(spark):
    texts = planted()
    want, links = brute(texts)
    got = {r.doc_id: r for r in dedup_lines(docs(spark, texts)).collect()}
    assert len(links) > 100
    wrong = [i for i, t in enumerate(want) if got[i].text != t]
    assert len(wrong) <= 0.03 * len(texts)
    for i, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        assert got[i].n_lines == len(lines)
        assert got[i].n_removed == len(lines) - (len(got[i].text.split("\n")) if lines and got[i].n_removed < len(lines) else len(lines) - got[i].n_removed)


def test_rounds_reach_members_the_first_pivot_misses(spark):
    """One bucket whose members form a chain: each resembles its neighbours only."""
    sets = [(i, list(range(10 * i, 10 * i + 100))) for i in range(12)]
    buckets = spark.createDataFrame([(1, i) for i, _ in sets], "k long, h long")
    table = spark.createDataFrame(sets, "h long, s array<long>")
    got = {r.node: r.component for r in line_components(buckets, table, 0.8).collect()}
    assert got.get(0, 0) == 0 and len(set(got.values())) < len(sets)


def test_edges_ids_and_clashing_columns(spark):
    df = edge_docs(spark).withColumnRenamed("source", "N_LINES")
    out = dedup_lines(df)
    rows = out.collect()
    assert len(rows) == df.count() and out.columns.count("n_lines") == 1 and "N_LINES" not in out.columns
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].text is None and by_id[1].text == "" and by_id[6].text == "" and by_id[6].n_removed == 1
    assert by_id[11].text == "same line" and by_id[11].n_removed == 2
    assert by_id[None].text == "no id at all here" and by_id[2].text == "   \n\t "
    assert dedup_lines(empty_docs(spark)).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a\nb", "", "", 0)], DOCS)
    plan = dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan


def every_shingle(line):
    """The shingles by their definition, position by position."""
    out, at = set(), 0
    for run in re.findall(r"\S+|\s+", line):
        if not run.isspace():
            out.add(line[at:at + 9])
            if len(run) > 8:
                out |= {line[i:i + 9] for i in range(at, at + len(run)) if i + 9 <= len(line)}
        at += len(run)
    return out


def test_shingles_start_at_every_character_of_unspaced_runs(spark):
    rng = random.Random(8)
    lines = ["abcdefgh ijk", "abcdefghi", "ab cdefghijklm no", "x" * 30, "q", "\U00020000" * 12 + " a", "\u3042\u3044\u3046" * 5]
    lines += ["".join(rng.choice("abcde    ") for _ in range(50)).strip() or "a" for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string")
    got = {r.i: set(r.s) for r in df.select("i", shingles(F.col("line")).alias("s")).collect()}
    flat = spark.createDataFrame([(i, x) for i, t in enumerate(lines) for x in every_shingle(t)], "i int, x string")
    want = {}
    for r in flat.select("i", F.xxhash64("x").alias("h")).collect():
        want.setdefault(r.i, set()).add(r.h)
    assert got == want


def test_unspaced_near_copies_link(spark):
    rng = random.Random(9)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)]
    texts, pairs = [], 120
    for i in range(pairs):
        line = "".join(rng.choice(han if i % 2 else "abcdefghijklmnop0123456789/") for _ in range(60))
        near = rng.choice("xyz") + line if i % 4 < 2 else line + rng.choice("xyz")
        a, b = every_shingle(line), every_shingle(near)
        assert len(a & b) >= 0.95 * len(a | b)
        texts += [line, near]
    got = {r.doc_id: r.n_removed for r in dedup_lines(docs(spark, texts)).collect()}
    assert not any(got[2 * i] for i in range(pairs))
    assert sum(got[2 * i + 1] for i in range(pairs)) >= 0.96 * pairs


def hot_passage(rng, few):
    """Lines that share 14 of 20 words, with some near copies: few words make the rest meet often."""
    passage = [f"{rng.choice('bcdfg')}{i}shared" for i in range(14)]
    lines = []
    for i in range(220):
        own = [rng.choice(few) if few else f"own{rng.randrange(10**4)}" for _ in range(6)]
        line = [*own[:3], *passage, *own[3:]]
        lines.append(" ".join(line))
        if i % 10 == 0:
            lines.append(" ".join([*line, f"z{i}"]))
    return list(dict.fromkeys(lines))


def test_every_link_of_a_bucket_is_found(spark, monkeypatch):
    rng = random.Random(11)
    for few, block in ((None, 256), (["ka", "lo", "mi", "nu", "pe", "ra"], 16)):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        lines = hot_passage(rng, few)
        sets = [(i, line) for i, line in enumerate(lines)]
        table = spark.createDataFrame(sets, "h long, line string").select("h", shingles(F.col("line")).alias("s"))
        # One bucket with all lines: a pivot seldom meets the near copy of a line.
        buckets = spark.createDataFrame([(7, i) for i in range(len(lines))], "k long, h long")
        got = {r.node: r.component for r in line_components(buckets, table).collect()}
        s = [every_shingle(x) for x in lines]
        links = [(a, b) for a in range(len(s)) for b in range(a) if len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b])]
        found = sum(got.get(a, a) == got.get(b, b) for a, b in links)
        assert len(links) >= 20 and found == len(links)  # recall 1 in a shared bucket
        linked = {x for pair in links for x in pair}
        assert set(got) <= linked


def test_repeated_and_null_ids_are_rows_of_their_own(spark):
    line = "one line that is long enough to be compared with all the others here"
    rows = [(5, line, "en", "s", 0), (5, line, "en", "s", 0), (None, line + " x", "en", "s", 0), (None, line, None, None, None)]
    out = dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == 4 and sorted(r.n_removed for r in out) == [0, 1, 1, 1]
    assert [(r.doc_id, r.text) for r in out if not r.n_removed] == [(5, line)]
    only_null = dedup_lines(spark.createDataFrame(rows[2:], DOCS)).collect()
    assert sorted(r.n_removed for r in only_null) == [0, 1]


def test_columns_named_like_inner_ones_stay(spark):
    names = ["_id", "_stay", "_lines", "_n", "_at", "id", "row", "given", "lines", "at", "n", "stay", "place", "none", "h", "N_LINES"]
    line = "one line that is long enough to be compared with all the others here"
    df = spark.createDataFrame([(i, line, *[f"{n}{i}" for n in names]) for i in range(2)], ", ".join(f"{n} string" if n not in ("doc_id",) else n for n in ["doc_id", "text", *names]).replace("doc_id", "doc_id long", 1))
    out = {r.doc_id: r for r in dedup_lines(df).collect()}
    for i in range(2):
        assert all(out[i][n] == f"{n}{i}" for n in names[:-1]) and out[i].n_lines == 1
    assert [out[i].n_removed for i in range(2)] == [0, 1]


def test_bitmaps_rule_out_no_link_and_most_others(spark):
    """Sizes and bitmaps against exact Jaccard, for sets from one shingle to far more than the bitmap has bits."""
    rng = random.Random(12)
    sets = {}
    for i in range(60):
        base = [rng.getrandbits(63) for _ in range(rng.choice([1, 5, 40, 300, 900]))]
        near = base[:-max(1, len(base) // 12)] + [rng.getrandbits(63)] if i % 2 and len(base) > 1 else base + [rng.getrandbits(63)]
        sets[2 * i], sets[2 * i + 1] = base, near
    table = spark.createDataFrame(list(sets.items()), "h long, s array<long>")
    marked = line_dedup._marked(spark.createDataFrame([(1, h) for h in sets], "k long, h long"), table)
    every = line_dedup._end(marked, "a").join(line_dedup._end(marked, "b"), "k").where("a < b")
    got = {(r.a, r.b) for r in every.where(line_dedup._possible(0.8)).select("a", "b").collect()}
    links = {(a, b) for a in sets for b in sets if a < b and len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))}
    assert len(links) >= 40 and links <= got
    small = {(a, b) for a, b in got if len(sets[a]) < 100}
    assert not small - {(a, b) for a, b in small if a // 2 == b // 2}


def test_tallies_rule_out_no_link_and_most_others(spark):
    """Sizes and bin tallies against exact Jaccard, for sets from one shingle to over 127 a bin."""
    rng = random.Random(13)
    sets = {}
    for i in range(60):
        base = [rng.getrandbits(64) - 2**63 for _ in range(rng.choice([1, 5, 40, 120, 400, 6000]))]
        near = base[:-max(1, len(base) // 12)] + [rng.getrandbits(63)] if i % 2 and len(base) > 1 else base + [rng.getrandbits(63)]
        sets[2 * i], sets[2 * i + 1] = base, near
    table = spark.createDataFrame(list(sets.items()), "h long, s array<long>").withColumn("s", F.sort_array("s"))
    described = line_dedup._binned(table).select("h", F.size("s").alias("size"), *line_dedup._tallies(F.col("below")))
    tallied = line_dedup._tallied(spark.createDataFrame([(1, h, 120) for h in sets], "k long, h long, n int"), described)
    every = line_dedup._side(tallied, "a").join(line_dedup._side(tallied, "b"), "k").where("a < b")
    got = {(r.a, r.b) for r in every.where(line_dedup._plausible(0.8)).select("a", "b").collect()}
    links = {(a, b) for a in sets for b in sets if a < b and len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))}
    assert len(links) >= 40 and links <= got
    assert not {(a, b) for a, b in got if 40 <= len(sets[a]) <= 121 and a // 2 != b // 2}


def test_only_lines_of_plausible_pairs_are_read_again(spark, monkeypatch):
    """Lines that share a bucket by a common passage alone have no shingle set built."""
    rng = random.Random(14)
    passage = " ".join(sentence(rng, 12) for _ in range(1))
    texts = [f"{sentence(rng, 14)} {passage} {sentence(rng, 14)} {i}" for i in range(120)]
    texts += [texts[0] + " x", texts[1] + " x"]
    asked, sets = [], line_dedup._shingle_sets
    monkeypatch.setattr(line_dedup, "_shingle_sets", lambda rows, wanted: asked.append(wanted.count()) or sets(rows, wanted))
    out = {r.doc_id: r.n_removed for r in dedup_lines(docs(spark, texts)).collect()}
    assert out[120] == out[121] == 1 and sum(out.values()) == 2
    assert sum(asked) < 30


def test_prefixes_alone_become_rows(spark, monkeypatch):
    """Lines of a wide bucket meet on the rare shingles of their prefixes; no other shingle makes a row."""
    rng = random.Random(15)
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    lines = hot_passage(rng, None)
    table = spark.createDataFrame(list(enumerate(lines)), "h long, line string").select("h", shingles(F.col("line")).alias("s"))
    written, write = {}, line_dedup.handover

    def spy(df, name):
        out = write(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "handover", spy)
    line_components(spark.createDataFrame([(7, i) for i in range(len(lines))], "k long, h long"), table)
    total = table.agg(F.sum(F.size("s"))).first()[0]
    assert 0 < written["line-prefixes"] <= 0.2 * total + 2 * len(lines)


def test_only_texts_that_lose_lines_meet_the_lines_that_stay(spark, monkeypatch):
    written = {}
    real = line_dedup.handover
    monkeypatch.setattr(line_dedup, "handover", lambda df, name: written.setdefault(name, real(df, name)))
    rng = random.Random(11)
    texts = [sentence(rng, 14) + "\n\n" + sentence(rng, 12) for _ in range(30)]
    texts += [None, "", " \n", texts[3] + "\n" + sentence(rng, 13), texts[4], texts[5].upper() + "\n"]
    out = dedup_lines(docs(spark, texts))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in out.collect()}
    assert [got[i][0] for i in range(len(texts))] == brute(texts)[0]
    assert sorted(i for i in got if got[i][1]) == [33, 34, 35]
    assert written["lines-cut"].count() == 3
    # The texts that lose nothing come from a branch without a shuffle.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1


def test_bins_of_hashes_at_their_limits_and_by_no_lambda(spark):
    """Counts below each bin by their definition; no element of a set passes an interpreted function."""
    rng = random.Random(16)
    least = [(j - 16) << 59 for j in range(32)]
    sets = [[], least, [x - 1 for x in least[1:]] + [2**63 - 1], sorted({rng.getrandbits(64) - 2**63 for _ in range(300)}), [-2**63], [-1, 0, 1]]
    table = spark.createDataFrame(list(enumerate(sets)), "h long, s array<long>")
    binned = line_dedup._binned(table)
    got = {r.h: list(r.below) for r in binned.collect()}
    assert got == {h: [sum(x < low for x in s) for low in least] + [len(s)] for h, s in enumerate(sets)}
    assert binned.columns == ["h", "s", "below"] and "lambda" not in binned._jdf.queryExecution().optimizedPlan().toString()


def test_short_words_are_passed_whole_with_any_blanks_between(spark):
    rng = random.Random(17)
    lines = ["a  b", "ab \t cd\x0b", "abcdefgh", "abcdefghi j", "\x85abc de\u00a0fgh ij", "a\x0cb", "  lead"]
    lines += ["".join(rng.choice("ab\t\x0b\x0c\r \u00a0") for _ in range(rng.randint(1, 60))) for _ in range(300)]

    def starts(line):
        """Shingles by position: at each start of a run, and at each character of a run of more than eight."""
        out = set()
        for run in re.finditer(r"[^ \t\n\x0b\x0c\r]+", line):
            out.add(line[run.start():run.start() + 9])
            if len(run.group()) > 8:
                out |= {line[i:i + 9] for i in range(run.start(), run.end()) if i + 9 <= len(line)}
        return out

    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {r.i: sorted(r.s) for r in df.select("i", shingles(F.col("line")).alias("s")).collect()}
    flat = spark.createDataFrame([(i, x) for i, t in enumerate(lines) for x in starts(t)], "i int, x string")
    want = {i: [] for i in range(len(lines))}
    for r in flat.select("i", F.xxhash64("x").alias("h")).collect():
        want[r.i].append(r.h)
    assert got == {i: sorted(x) for i, x in want.items()}


def method_bytes(spark, df):
    """The longest method of each piece of whole-stage code in the plan."""
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan()))]


def test_methods_that_compare_and_cut_lines_are_compiled(spark):
    """HotSpot interprets methods of more than 8,000 bytes for ever, however often they run."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tallied = spark.createDataFrame([], ", ".join(["k long", "h long", "n int", "c long", "size int", *[f"t{i} long" for i in range(line_dedup.TALLIES)]]))
        rows = spark.createDataFrame([], "id long, text string, row long")
        for df in (line_dedup._bucket_pairs(tallied, 0.8), line_dedup._first_pairs(tallied, 0.8), line_dedup.distinct_lines(rows)):
            sizes = method_bytes(spark, df)
            assert sizes and max(sizes) < 8000
        # Nothing but a single null passes a lambda, so the keys are compiled and not interpreted.
        keys = rows.select(line_dedup._band_keys(F.array("id"), F.array("row")).alias("keys"))
        assert keys._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction(") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stars_contract_in_two_rounds(spark, monkeypatch):
    from segmark.llm import components

    names, write = [], components.handover
    monkeypatch.setattr(components, "handover", lambda df, name: names.append(name) or write(df, name))
    edges = spark.createDataFrame([(1000 * s, 1000 * s + i) for s in range(30) for i in range(1, 300)], "a long, b long")
    got = components.connected_components(edges).collect()
    assert {(r.node, r.component) for r in got} == {(1000 * s + i, 1000 * s) for s in range(30) for i in range(300)}
    assert names.count("cc-moved") == 2
