"""Archives, decision lists, toxicity, token counts, mixing and page extraction."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose, words
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import clashing, edge_texts
from pyspark.sql import functions as F
from rows import same_rows

from tickforge.llm import decision_list, html_extraction, mixing, ordinal_toxicity, page_model, viterbi_counts, warc
from tickforge.llm.kernel import byte_view
from tickforge.llm.shared import fresh_path

PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"

# Archives


def test_archives_equal_sql(spark, tiny, duck):
    same_rows(warc.query(spark, tiny).toPandas(), duck.sql(warc.SQL).df())


def test_archives_in_small_ranges(spark):
    long = "x" * 150
    rows = [(3, "u", long), (1, "u v\r\n", long), (2, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 60), (9, "u", "é" * 60), (9, "u", "é" * 60), (None, "u", long)]
    df = clashing(spark.createDataFrame(rows, PAGES), "digest", "first", "payload", "size")
    archives = warc.write_archives(warc.with_revisits(df), fresh_path(spark, "warc"), archive_bytes=900)
    got = warc.read_archives(archives, split_bytes=70).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got) == Counter(
        [(3, "revisit", 1, 150), (1, "response", None, 150), (2, "revisit", 1, 150), (None, "revisit", 1, 150), (4, "response", None, 5), (5, "response", None, 5), (6, "response", None, 0), (7, "response", None, 0), (8, "response", None, 120), (9, "revisit", 8, 120), (9, "revisit", 8, 120)]
    )
    assert {bytes(r["payload"]) for r in got if r["page_id"] == 8} == {("é" * 60).encode()}
    assert warc.read_archives(warc.write_archives(warc.with_revisits(df.limit(0)), fresh_path(spark, "warc"))).count() == 0


def test_archives_of_very_long_and_repeated_pages(spark):
    long = "".join(f"<p>{k * 7919 % 1_000_003}</p>" for k in range(300_000))
    df = spark.createDataFrame([(1, "u", long), (2, "v", long), (2, "v", long), (3, "w", long + "x")], PAGES)
    got = warc.read_archives(warc.write_archives(warc.with_revisits(df), fresh_path(spark, "warc"), archive_bytes=1000), split_bytes=100_000, keep_payload=False).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got) == Counter([(1, "response", None, len(long)), (2, "revisit", 1, len(long)), (2, "revisit", 1, len(long)), (3, "response", None, len(long) + 1)])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=200), min_size=1, max_size=8), st.integers(1, 300))
def test_every_record_has_one_owner(payloads, step):
    """Payloads hold gzip magic and whole gzip members; ranges of any size find each record once."""
    payloads = [p + warc.MAGIC + gzip.compress(p) for p in payloads]
    data = b"".join(warc.record(k, "u", p, len(p), hashlib.sha256(p).hexdigest(), None, level=k % 3) for k, p in enumerate(payloads))
    found = [block.partition(b"\r\n\r\n")[2] for lo in range(0, len(data), step) for _, _, block in warc.records_in(io.BytesIO(data), len(data), lo, min(lo + step, len(data)))]
    assert found == payloads and gzip.decompress(data).count(b"WARC/1.1") == len(payloads)


# Decision lists


def brute_statistics(text):
    w, c, cover = words(text), Counter(), set()
    for i in range(len(w) - 2):
        c[tuple(w[i : i + 3])] += 1
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def test_statistics_equal_brute_force(documents):
    df = clashing(documents(*edge_texts(), "a b a b a b", "a b c d a b c", "x\ny\nx\n\n x\nx"), "n_words", "w", "l")
    want = [(r["doc_id"], *brute_statistics(r["text"])) for r in df.collect()]
    got = [tuple(r) for r in decision_list.statistics(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()]
    assert sorted(got) == sorted(want)


def test_list_learns_a_planted_rule(spark, documents):
    good, bad = [prose(80 + k, k) for k in range(60)], [" ".join(f"{w} ***" for w in prose(60 + k, 900 + k).split()) for k in range(40)]
    df = documents(*good, *bad)
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(100)] + [(None, 1, 0), (3, None, 0)], LABELS)
    rules = decision_list.learn(df, labels)
    assert rules and all(len(r) <= decision_list.MOST_CONDITIONS for r in rules)
    kept = {r["doc_id"]: r["kept"] for r in decision_list.judged(df, rules).collect()}
    assert all(kept[k] == (k < 60) for k in kept)
    assert "Python" not in decision_list.judged(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert decision_list.learn(df, labels.where("quality = 1")) == [] and decision_list.judged(df.limit(0), rules).count() == 0


# Toxicity


def test_toxicity_on_held_out_rows(spark, documents):
    texts = [prose(60, k, 300) + (f" vile{'' if k % 4 else ' vile awful'} " if k % 2 else "") for k in range(300)]
    df = clashing(documents(*texts, None, "", "VILE!"), "severity", "grade", "score")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)] + [(None, 1, 1)], LABELS)
    model = ordinal_toxicity.learn(df, labels)
    got = {r["doc_id"]: r for r in ordinal_toxicity.graded(df, model).collect()}
    assert all(got[k]["toxic"] == bool(k % 2) for k in range(200, 300))
    assert not got[300]["toxic"] and not got[301]["toxic"] and got[302]["toxic"]
    assert (np.diff(model.thresholds) > 0).all() and 0 <= got[1]["severity"] <= ordinal_toxicity.GRADES - 1
    kept = ordinal_toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(not r["toxic"] for r in got.values())
    none = ordinal_toxicity.learn(df, labels.where("toxic = 0"))
    assert not any(r["toxic"] for r in ordinal_toxicity.graded(df, none).collect()) and ordinal_toxicity.graded(df.limit(0), none).count() == 0


@pytest.mark.parametrize("toxic", [5, 11, 50])
def test_few_toxic_labels_reject_no_clean_text(spark, documents, toxic):
    """Whether there is enough to learn from or not: clean, null and empty texts stay, with severities near the share of toxic labels."""
    texts = [prose(60, k, 300) + (f" vile awful{k % 3} " if k < toxic else "") for k in range(300)]
    df = documents(*texts, None, "", "short clean text", "word " * 200_000)
    model = ordinal_toxicity.learn(df, spark.createDataFrame([(k, 1, int(k < toxic)) for k in range(300)], LABELS))
    got = {r["doc_id"]: r for r in ordinal_toxicity.graded(df, model).collect()}
    assert not any(got[k]["toxic"] or got[k]["severity"] > 0.4 for k in range(toxic, 304))
    assert sum(got[k]["toxic"] for k in range(toxic)) in ((0, toxic) if toxic < 50 else (toxic,))
    assert got[300]["severity"] == got[301]["severity"] and got[300]["severity"] < 0.1


def test_equal_rows_and_ties_score_alike(spark, documents):
    df = documents(*(("vile " if k % 2 else "kind ") + prose(9, k // 2) for k in range(80)), "vile", "vile", "vile vile vile")
    model = ordinal_toxicity.learn(df, spark.createDataFrame([(k, 1, k % 2) for k in range(80)], LABELS))
    got = {r["doc_id"]: (r["severity"], r["grade"], r["toxic"]) for r in ordinal_toxicity.graded(df, model).collect()}
    assert got[80] == got[81] == got[82] and got[80][2]


def test_graded_labels_order_scores():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 600)
    held = [np.unique(np.concatenate([rng.choice(2000, 30), 5000 + np.arange(g)])) for g in grade]
    rows = np.repeat(np.arange(600), [len(x) for x in held])
    model = ordinal_toxicity.fit(grade, rows, np.concatenate(held))
    severity = model.above(np.bincount(rows, weights=model.weights[np.concatenate(held)], minlength=600)).sum(axis=1)
    means = [severity[grade == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1


# Token counts


def test_counts_equal_the_library(documents):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = viterbi_counts.unigram_pieces(viterbi_counts.default_vocabulary())
    held = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    held.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [*edge_texts(), "  two  spaces ", "▁x y", "日本語 ☃☃☃ a☃b", "<unk> <s> x</s>", prose(200, 1), "withoutspaces日本" * 20_000]
    df = clashing(documents(*texts), "n_tokens", "n_chars2")
    got = {r["doc_id"]: r["n_tokens"] for r in viterbi_counts.token_counts(df).collect()}
    assert got == {k: len(held.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}
    assert viterbi_counts.token_counts(df.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abc ☃", max_size=24), st.integers(0, 3))
def test_ties_equal_the_library(text, kind):
    from tokenizers import Tokenizer, models, pre_tokenizers

    scores = {0: -1.0, 1: -2.0, 2: -1.0, 3: -3.0}
    pieces = [("<unk>", 0.0), ("▁", -1.0), *((p, scores[(len(p) + kind) % 4] * (len(p) if kind < 2 else 1)) for p in ("a", "b", "ab", "ba", "aab", "bc", "▁a", "abc"))]
    held = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    held.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    data, offsets = byte_view(pa.array([text]))
    assert viterbi_counts.Words(viterbi_counts.Viterbi(pieces)).totals(data, offsets).tolist() == [len(held.encode(text, add_special_tokens=False).ids)]


# Mixing


def filled(sizes: dict, weights=(5.0, 2.0, 1.0)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


def test_targets_and_copies(documents):
    rows = [(k, prose(1 + k % 40, k), ("a", "b", None, "é", "Z", "tiny")[min(5, k % 7)]) for k in range(700)] + [(900, None, "empty"), (901, " ", "empty"), (None, "x y", "a"), (5, prose(6, 5), "tiny")]
    df = clashing(documents(*rows), "rate", "seed", "target", "size", "of", "mix_rate", "MIX_copies", "mix_copy", "mix_source")
    sizes: Counter = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    want = filled(sizes)
    counted = mixing.with_copies(mixing.doc_sizes(df), mixing.mixing_plan(mixing.doc_sizes(df))).collect()
    assert len(counted) == len(rows)
    taken: Counter = Counter()
    for r in counted:
        assert abs(r["mix_target"] - want[r["source"]]) < 1e-6 and r["mix_copies"] in (int(r["mix_rate"]), int(r["mix_rate"]) + 1) and r["mix_copies"] <= 2
        taken[r["source"]] += r["size"] * r["mix_copies"]
    assert all(abs(taken[s] - want[s]) <= max(40, 0.05 * want[s]) for s in want)
    out = mixing.mixed(df)
    assert out.columns == df.columns and Counter(r["doc_id"] for r in out.collect()) == Counter({d: n for d, n in sum((Counter({r["doc_id"]: r["mix_copies"]}) for r in counted), Counter()).items() if n})
    assert mixing.mixed(df.limit(0)).count() == 0


# Pages


def test_model_on_held_out_layouts():
    model = page_model.train(page_model.labelled_pages())
    right = total = 0
    for page in page_model.labelled_pages(100, seed=99):
        tree = page_model.parse(page)
        for node, p in zip(tree.nodes, model.marginals(tree)):
            if node.text is not None:
                total += 1
                right += (p >= 0.5) == bool(node.label)
    assert right / total > 0.97


def test_marginals_equal_enumeration():
    import itertools
    import math

    model = page_model.train(page_model.labelled_pages(40))
    tree = page_model.parse("<body><nav><a href=x>one</a></nav><article><p>Some words here.</p></article></body>")
    n, total = len(tree.nodes), Counter()
    for labels in itertools.product((0, 1), repeat=n - 1):
        labels, score = (0, *labels), 0.0
        for i in range(1, n):
            node = tree.nodes[i]
            odds = model.edges.get((node.kind, labels[node.parent]), model.edge_default[labels[node.parent]])
            score += -math.log1p(math.exp(-odds if labels[i] else odds)) + (sum(model.seen.get(f, 0) for f in node.seen) if labels[i] else 0)
        for i in range(n):
            total[i, labels[i]] += math.exp(score)
    got = model.marginals(tree)
    assert all(abs(got[i] - total[i, 1] / (total[i, 0] + total[i, 1])) < 0.02 for i in range(1, n))


def test_pages_of_the_smallest_data(spark, tiny):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    for r in html_extraction.query(spark, tiny).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_broken_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p"), (5, "u", "<article><h1>A &amp; B</h1><p>Some &lt;text&gt; that is\n long &#233;nough.<div class=ad>buy now</div><!-- c --><p>More <b>text</i> follows here.</article></div></p>"), (6, "u", "<script>x<p>y</script>" + "<div>" * 3000), (6, "u", "<textarea><p>in a form</textarea>")]
    got = {r["page_id"]: r for r in html_extraction.extracted(clashing(spark.createDataFrame(rows, PAGES), "text", "n_chars")).where("page_id < 6").collect()}
    assert [got[k]["text"] for k in (1, 2)] == ["", ""] and got[2]["url"] is None
    assert got[5]["text"] == "A & B\nSome <text> that is long énough.\nMore text follows here."
    assert html_extraction.extracted(spark.createDataFrame([], PAGES)).count() == 0


#: Pages of other hands than the generator's: foreign, coded and utility class names, no article element, odd nesting.  One @ starts a run of main text.
FOREIGN = (
    "<body><div class='kopfzeile'><ul><li><a href=/>Start</a></li><li><a href=/n>Neues</a></li></ul></div><div class='hauptteil'><h1>@Der Fluss steigt wieder</h1><p>@Nach drei Tagen Regen steht das Wasser so hoch wie seit Jahren nicht mehr.</p><p>@Die Stadt hat den Uferweg gesperrt und rät, Keller zu räumen.</p></div><div class='fusszeile'><a href=/i>Impressum</a> <a href=/d>Datenschutz</a></div></body>",
    "<body><div class='css-1x9k2'><div class='css-77aq'><a href=/>Home</a><a href=/w>World</a><a href=/s>Sport</a></div><div class='css-9zz1'><h1>@Harbour reopens after storm</h1><div class='css-p0'><p>@Ships returned to the harbour on Friday, two days after the storm closed its mouth.</p><p>@The harbour master said that the channel had been swept twice before the first tanker came in.</p></div></div><div class='css-foot'><p>&copy; 2024 Coast Daily</p></div></div></body>",
    "<body><nav class='o-nav'><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><main class='l-grid'><section class='c-post__body'><h2>@Bread without kneading</h2><p>@Stir flour, water, salt and a little yeast, and leave the bowl covered over night.</p><ul><li>@500 g of flour, sieved twice.</li><li>@350 g of water at room temperature.</li></ul><p>@Bake it in a closed pot, which keeps the steam in.</p></section><aside class='c-rail'><h3>Popular</h3><ul><li><a href=/x>Ten soups</a></li><li><a href=/y>Rye at home</a></li></ul></aside></main><footer><p>Imprint and contact</p></footer></body>",
    "<table width=100%><tr><td><a href=1>Index</a> | <a href=2>Next</a></td></tr><tr><td><p>@In the spring of that year my grandfather walked to the coast, which took him nine days, and he never spoke of it.</p><p>@What we know of it comes from the book that he kept, and from the people at whose tables he sat.</p></td></tr><tr><td><small><a href=mailto:x>Mail the editor</a></small></td></tr></table>",
    "<body><header><p>The Valley Paper</p></header><div id=cuerpo><h1>@El puente nuevo</h1><p>@El puente sobre el río se abrió ayer después de cuatro años de obras y de muchas discusiones.</p><p>@Los vecinos cruzaron primero a pie, luego pasaron los autobuses.</p></div><div class='publicidad'><a href=/c>Compre ahora</a></div><section id=comentarios class=comments><h3>Comments</h3><div class=comment><p>I was there and it was lovely to see all the people on it.</p></div></section></body>",
    "<body><div class='max-w-3xl mx-auto px-4'><h1 class='text-4xl font-bold'>@Why we moved to smaller teams</h1><p class='mt-4 leading-7'>@Three years ago every change went through a single group of twenty people, and it took weeks.</p><pre>@make all && make test</pre><p class='mt-4 leading-7'>@Since then each part has an owner, and most changes are out within a day.</p></div><form class='mt-10'><label>Get our letters</label><input><button>Sign up</button></form><div class='cookie-bar'><p>We use cookies to measure visits.</p><button>Fine</button></div></body>",
)


def test_model_on_pages_of_other_hands():
    """Runs of main text found, and other runs left out, on layouts that nothing was fitted on."""
    model = page_model.train(page_model.labelled_pages())
    got = {True: [], False: []}
    for page in FOREIGN:
        tree = page_model.parse(page)
        for node, p in zip(tree.nodes, model.marginals(tree)):
            if node.text is not None:
                got[node.text.startswith("@")].append((p >= 0.5) == node.text.startswith("@"))
    shares = {k: sum(v) / len(v) for k, v in got.items()}
    print("main runs found", shares[True], "of", len(got[True]), "other runs left out", shares[False], "of", len(got[False]))
    assert shares[True] >= 0.8 and shares[False] >= 0.6


def test_broken_pages_take_linear_time():
    """A megabyte each of what made parsers look at a page's rest again and again."""
    import time

    pages = {"open tags": "<a " * 330_000, "stray ends": "<b>" * 170_000 + "</i>" * 120_000, "ends behind a block": "<i><div>" + "<b>" * 150_000 + "</i>" * 120_000, "quotes": '<a "x" ' * 140_000 + '">', "names": "<a" * 250_000 + '"' + "<a" * 250_000 + ">'", "signs": "<" * 1_000_000, "siblings": "<ul><p>" + "<span>" * 60_000 + "<li>" * 60_000, "half quotes": "<a '" * 125_000 + ">" + '<b "' * 125_000}
    for name, page in pages.items():
        began = time.process_time()
        page_model.parse(page)
        assert time.process_time() - began < 8, name


def test_broken_pages_lose_no_main_text(spark):
    body = "<article><h1>A headline here</h1><p>Article text that is long enough.</p></article>"
    before = ("<svg-icon name=x></svg-icon>", "<title-bar>", "<select-box></select-box>", "<object-view>", "<svg viewBox='0 0 1 1'/>", "<math/>", "<svg>", "<select><option>", "<noscript>", "<canvas>", "<object data=x>", "<math>")
    got = [page_model.main_text(f"<p>a</p>{x}{body}", page_model.train(page_model.labelled_pages(60))) for x in before]
    assert [x for x, text in zip(before, got) if "Article text that is long enough." not in text] == []
    inside = "<article><h1>A headline here</h1><p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn><mspace/></math> is larger than <canvas>a drawn curve</canvas> here.</p><object data=x><p>This is the fallback text of it.</p></object><p>Text <svg><text>no</text></svg>goes on <select><option>no</select>to its end.</p></article>"
    row = html_extraction.extracted(spark.createDataFrame([(1, "u", inside)], PAGES)).first()
    assert row["text"] == "A headline here\nThe sum x+1 is larger than a drawn curve here.\nThis is the fallback text of it.\nText goes on to its end."
    many = "<select><svg>" * 100_000 + body  # each end tag that is missing is looked for once
    assert len(page_model.parse(many).nodes) > 100_000
