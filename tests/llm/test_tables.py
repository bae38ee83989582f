"""Search, page extraction, chat formatting and the pipeline."""

import math
import random

import pytest

import corpus_pipeline
from sluice.llm import chat, html, nearest


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 40)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(nearest, "TILE", 16)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], "x") for i in range(300)]
    rows += [(300 + i, [1.0] * 8, "hot") for i in range(150)] + [(i, None, "x") for i in (500, 501)]
    rows += [(550, [0.0] * 8, "x"), (551, [float("nan")] * 8, "x"), (552, [1.0, None], "x"), (553, [], "x"), (None, [1.0] * 8, "x")]
    rows += [(600, [1.0, 2.0], "other length"), (601, [2.0, 4.0], "other length"), rows[0], rows[300]]
    got = {}
    for r in nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, Embedding_2 string")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: v for i, v, _ in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    for q in (i for i in good if i % 50 == 0):
        def cos(v):
            dot = lambda a, b: sum(x * y for x, y in zip(a, b))
            return dot(v, good[q]) / (math.sqrt(dot(v, v)) * math.sqrt(dot(good[q], good[q])))
        want = sorted(((-cos(v), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:5]
        mine = sorted(got[q])
        assert [i for _, i, _ in mine] == [i for _, i in want] and [r for r, _, _ in mine] == list(range(1, len(want) + 1))
        assert all(math.isclose(s, -w, abs_tol=1e-12) for (_, _, s), (w, _) in zip(mine, want))
    assert set(got) == {i for i in good if i % 50 == 0}
    assert nearest.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def _page(i, body, extra=""):
    return (f"<html><head><title>T{i}</title><script>var a='</p>';</script></head><body><nav><ul><li>Home</li></ul></nav>"
            f"<div class='cookie-notice'>We use cookies</div>{extra}<div id=wrap><p>Site motto</p><h1>Title {i}</h1>{body}<p>Read more here</p></div>"
            "<div class=comments><p>nice!</p></div><footer>&copy; x</footer></body></html>")


def test_html_template_is_learnt_per_host(spark):
    rows = [(i, f"https://a.example/{i}", _page(i, f"<p>Body {i} &amp; more<p>second\n {i}<br>line")) for i in range(8)]
    rows += [(20, "https://a.example/copy", rows[0][2]), (21, "http://other.example", "<article><h1>A</h1>x &lt; y<p>b</article><aside>no</aside>"),
             (22, None, None), (23, "https://a.example/", ""), (24, "nonsense", "a < b and <b>c")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(1, 8):
        assert got[i].text == f"Title {i}\nBody {i} & more\nsecond {i} line"
    assert got[21].text == "A\nx < y\nb"
    assert [got[i].text for i in (22, 23, 24)] == ["", "", "a < b and c"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(rows)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def _extracted(spark, rows):
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return {r.page_id: r.text.split("\n") for r in got}


def test_html_template_is_counted_over_all_pages_of_a_layout(spark):
    blog = lambda i, end: f"<body><div class=blog><article><p>Motto</p><p>Body {i}</p>{end}</article></div></body>"
    forum = lambda i: f"<body><div class='forum t{i}'><article><p>Post {i}</p><p>Forum rules</p></article></div></body>"
    rows = [(100 * h + i, f"https://h{h}.example/{i}", blog(f"{h} {i}", "<p>Licensed</p>" if i % 5 < 2 else "")) for h in range(6) for i in range(20)]
    rows += [(1000 + i, f"https://h0.example/f{i}", forum(i)) for i in range(5)]
    # copies of one article, each with an own set of template lines: no majority of pages
    rows += [(2000 + i, f"https://c.example/{i}", blog("same", "<p>Ad</p>" if i % 2 else "")) for i in range(8)]
    rows += [(2100 + i, f"https://c.example/x{i}", blog(f"other {i}", "<p>Ad</p>")) for i in range(4)]
    got = _extracted(spark, rows)
    for h in range(6):
        for i in range(20):
            assert got[100 * h + i] == [f"Body {h} {i}"] + ["Licensed"] * (i % 5 < 2)
    assert [got[1000 + i] for i in range(5)] == [[f"Post {i}"] for i in range(5)]
    assert all(got[2000 + i] == ["Body same"] for i in range(8))
    assert all(got[2100 + i] == [f"Body other {i}"] for i in range(4))


def test_html_long_flat_pages_are_matched_whole(spark):
    page = lambda i: ("<article>" + "".join(f"<p>a {i} {k}</p>" for k in range(17 + 3 * i)) + "<p>Read our terms</p>"
                      + "".join(f"<p>b {i} {k}</p>" for k in range(40 - 2 * i)) + "</article>")
    got = _extracted(spark, [(i, f"https://h.example/{i}", page(i)) for i in range(8)])
    for i in range(8):
        assert got[i] == [f"a {i} {k}" for k in range(17 + 3 * i)] + [f"b {i} {k}" for k in range(40 - 2 * i)]


def test_html_names_are_a_prior_only(spark):
    for name in ("layout no-sidebar", "page has-sidebar", "sidebar", "widget", "modal"):
        assert html.main_text(f"<div class='{name}'><article><p>whole</p></article></div><p>else and more</p>", []) == "whole"
        assert html.main_text(f"<div id='{name}'><main><p>whole</p></main></div>", []) == "whole"
        assert html.main_text(f"<div class='{name}'><p>most of the text of the page</p></div><p>else</p>", []).startswith("most of")
    inside = "".join(f"<p class='{c}'>{c}</p>" for c in ("notice", "alert", "related-work", "social-history"))
    assert html.main_text(f"<article>{inside}</article>", []) == "notice\nalert\nrelated-work\nsocial-history"
    assert html.main_text("<p>long text of the page</p><div class='post comments'><p>nice</p></div>", []) == "long text of the page"
    assert html.main_text("<form id=aspnet><p>all of it</p></form>", []) == "all of it"
    page = lambda i: f"<article><p>Body of {i}</p>" + ("<p class=notice>Join</p><p>Plain</p>" if i % 3 == 0 else "") + "</article>"
    got = _extracted(spark, [(i, f"https://h.example/{i}", page(i)) for i in range(12)])
    assert got == {i: [f"Body of {i}"] + ["Plain"] * (i % 3 == 0) for i in range(12)}


def test_html_implied_ends_comments_and_formulas():
    page = "<html><head><title>x</title>{}<article><p>Body</p></article>"
    for between in ("<body>", "", "<meta charset=utf-8><script>no()</script><body class=a>", "</head><body>"):
        assert html.main_text(page.format(between), []) == "Body"
    assert html.main_text("<head><title>x</title>Words <b>of</b> a body<p>more", []) == "Words of a body\nmore"
    assert html.main_text("<head><style>p{}</style><link rel=x></head><p>only", []) == "only"
    comments = "<article><p>A long body of text</p><{0} {1}><p>nice post!</p></{0}><p>its end</p></article>"
    for tag, name in (("div", "class='post comments'"), ("section", "id=comments"), ("ol", "class=comment-list"), ("article", "class=comment")):
        assert html.main_text(comments.format(tag, name), []) == "A long body of text\nits end"
    assert html.main_text("<article><p class=comment>A remark</p><p>on text</p></article>", []) == "A remark\non text"
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='t'>x=2</annotation></semantics></math>"
    assert html.main_text(f"<article><p>Let {formula} be a number</p></article>", []) == "Let x=2 be a number"


def test_html_deep_and_broken_pages():
    assert html.main_text("<div>" * 5000 + "x" + "</div>" * 3, []) == "x"
    assert html.main_text("<p>a<p>b</b></i><li>c<li>d", []) == "a\nb\nc\nd"
    assert html.main_text("<p title='open>x", []) in ("", "x")


def test_chat(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 70, "ann", "late"),
            (2, 0, "system", "alone"), (None, 0, "ann", "x"), (3, None, None, "who")]
    out = {(r.conv_id, r.perspective, r.segment): r for r in
           chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "y")).collect()}
    assert set(out) == {(1, p, s) for p in ("ann", "bob") for s in (0, 1)} | {(3, "unknown", -1)}
    r = out[1, "ann", 0]
    assert r.text == ("<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n"
                      "<|im_start|>user name=bob\n<|im_end|>\n")
    s, e = map(int, r.mask.split("-"))
    assert r.text[s:e] == "hi < |im_end|><|im_end|>" and r.n_masked == e - s and r.n_turns == 3
    assert out[1, "bob", 1].mask == "" and out[1, "bob", 1].n_masked == 0


def test_chat_segments_keep_the_setting_and_join_to_the_dialogue(spark):
    rows = [(1, None, "ann", f"early {i:03}") for i in range(150)] + [(1, 0, "system", "rules")]
    rows += [(1, i, ("ann", "bob")[i % 2], f"turn {i}") for i in range(1, 200)] + [(1, 100, "system", "more rules")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    got = chat.rotate(frame.repartition(3)).collect()
    for who in ("ann", "bob"):
        mine = sorted((r for r in got if r.perspective == who), key=lambda r: (r.segment, r.part))
        assert [(r.segment, r.part, r.n_turns) for r in mine] == [(-1, 0, 64), (-1, 1, 64), (-1, 2, 22), (0, 0, 64), (1, 0, 64), (1, 1, 1), (2, 0, 64), (3, 0, 8)]
        head = lambda role: "system" if role == "system" else "assistant" if role == who else f"user name={role}"  # noqa: E731, B023
        text = "".join(f"<|im_start|>{head(r[2])}\n{r[3]}<|im_end|>\n" for r in whole)
        assert "".join(r.text[r.lead :] for r in mine) == text
        assert all(text[r.start :].startswith(r.text[r.lead :]) for r in mine)
        spoken = [f"{r[3]}<|im_end|>" for r in whole if r[2] == who]
        assert [r.text[int(s) : int(e)] for r in mine for s, e in (x.split("-") for x in r.mask.split(",") if x)] == spoken
        rules = "<|im_start|>system\nrules<|im_end|>\n"
        assert [r.text[: r.lead] for r in mine] == [""] * 4 + [rules] + [rules + "<|im_start|>system\nmore rules<|im_end|>\n"] * 3


def test_chat_output_grows_with_the_turns(spark):
    def size(n):
        rows = [(1, i, ("system", "ann")[i % 2], f"turn {i:05}") for i in range(n)]
        got = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
        # the last 64 system turns before a segment, at its head
        for r in got:
            earlier = [f"<|im_start|>system\nturn {i:05}<|im_end|>\n" for i in range(0, 64 * r.segment, 2)]
            assert r.text[: r.lead] == "".join(earlier[-64:])
        return sum(len(r.text) for r in got)

    a, b, c = size(320), size(640), size(1280)
    assert c - b <= 2.2 * (b - a) and c < 3 * 1280 * len("<|im_start|>assistant\nturn 00000<|im_end|>\n")


def test_chat_edges(spark):
    schema = "conv_id long, TURN string, turn long, role string, Role int, text string"
    assert chat.rotate(spark.createDataFrame([], schema)).collect() == []
    long = "word " * 200_000
    rows = [(1, "x", 0, "ann", 7, long), (1, "y", 0, "ann", 8, long), (1, None, 1, "bob", None, "")]
    got = {r.perspective: r for r in chat.rotate(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"ann", "bob"} and got["ann"].n_turns == 2
    assert got["ann"].text == f"<|im_start|>assistant\n{long}<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n"


def test_pipeline_is_its_stages_and_matches_brute_force(spark, tmp_path_factory):
    from tests.llm.test_documents import _brute_lines, _components, _ids, _measures
    from sluice.llm import pii, quality

    sf = "/root/testdata/sf0.001"
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "MinHash near-dedup", "PII", "best-fit packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality.quality(docs).collect() if r.kept}
    assert not any(_measures(texts[i])[-1] for i in kept)
    texts = {i: t for i, t in texts.items() if i in kept}

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    holder, seen = {}, {}
    for i in sorted(texts):
        for k in {key(x) for x in texts[i].split("\n")}:
            holder.setdefault(k, i)
            seen[k] = seen.get(k, 0) + 1
    texts = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or seen[key(x)] < 2 or holder[key(x)] == i) for i, t in texts.items()}
    components = _components(texts)
    texts = {i: pii.redact(t, pii.find_spans(t)) for i, t in texts.items() if components[i][2]}
    want = {i: len(_ids("word_bpe_49k.json", t, 1)) for i, t in texts.items()}
    rows = corpus_pipeline.run(spark, sf).collect()
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
    # every stage but the last keeps the columns of documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns


@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op2_nearest_neighbours", "op8_quality_rules", "op9_chat_format", "op10_line_dedup"])
def test_registered_query_matches_its_sql(spark, name):
    import __spark_entry__ as E
    from tests.oracle_compare import compare, duck

    sf = "/root/testdata/sf0.001"
    result = compare(spark, name, E.queries()[name], E.oracle_sql()[name], sf, duck(sf))
    assert result["ok"], result


def test_pipeline_stages_give_workers_small_batches(spark, tmp_path, monkeypatch):
    from sluice.llm.frames import BATCH_BYTES

    rows = [(i, " ".join(f"word{(i + 1) * (k + 7) ** 2 % 9973}" for k in range(900))) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))  # 4 MB in one partition
    plain = type(docs).mapInArrow

    def bounded(self, func, *args, **kwargs):
        def run(batches):
            def small():
                for batch in batches:
                    if batch.nbytes > 2 * limit:
                        raise ValueError(f"a batch of {batch.nbytes} bytes")
                    yield batch

            return func(small())

        limit = BATCH_BYTES
        return plain(self, run, *args, **kwargs)

    monkeypatch.setattr(type(docs), "mapInArrow", bounded)
    for _, stage in corpus_pipeline.STAGES[1:]:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        assert stage(spark, docs, str(tmp_path)).count() >= len(rows)
