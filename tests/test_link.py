"""C and L hand cases on a tiny hand-made graph."""

from pyspark.sql import functions as F

from trawl.operators.candidates import candidates
from trawl.operators.link import label_class_table, link_entities, most_referred, most_similar
from trawl.sources.kb import KnowledgeGraph

R = "http://dbpedia.org/resource/"
W = "http://en.wikipedia.org/wiki/"


def kb(spark, labels, types, links, redirects=(), disambig=()):
    label = spark.createDataFrame([(R + i, n, lg) for i, n, lg in labels], "item string, name string, lang string")
    typ = spark.createDataFrame([(R + i, c) for i, c in types], "item string, class string")
    topic = spark.createDataFrame([(R + i, W + i) for i, _ in types], "item string, page string")
    link = spark.createDataFrame([(R + s, R + t) for s, t in links], "source string, target string")
    red = spark.createDataFrame([(R + s, R + d) for s, d in redirects], "src string, dst string")
    dis = spark.createDataFrame([(R + p, R + i) for p, i in disambig], "page string, item string")
    return KnowledgeGraph(label=label, redirect=red, disambig=dis, type=typ, link=link, topic=topic)


def reps(spark, rows):
    return spark.createDataFrame(rows, "mention_key string, class string, rep string")


P = "dbo:Person"


def test_one_candidate_and_none(spark):
    g = kb(spark, [("Ada", "Ada", "en")], [("Ada", P)], [("x", "Ada")])
    out = dict((r.rep, r.link) for r in most_referred(candidates(reps(spark, [("ada", P, "Ada"), ("bob", P, "Bob")]), g)).collect())
    assert out == {"Ada": W + "Ada"}


def test_count_tie_then_distance_then_page(spark):
    # Both items reached through the disambiguation page once, same in-links:
    # tie on count -> Levenshtein(rep, name) -> smaller page.
    g = kb(spark,
           [("Mars_a", "Marsa", "en"), ("Mars_b", "Mars", "en"), ("Mars_c", "Marz", "en")],
           [("Mars_a", P), ("Mars_b", P), ("Mars_c", P)],
           [("x", "Mars_a"), ("x", "Mars_b"), ("x", "Mars_c")],
           disambig=[("Mars_(disambiguation)", "Mars_a"), ("Mars_(disambiguation)", "Mars_b"),
                     ("Mars_(disambiguation)", "Mars_c")])
    c = candidates(reps(spark, [("mars", P, "Mars")]), g)
    # "Mars" is also a label of Mars_b: label + redirect(zero step) + disambiguation = 3x
    counts = {r.item.split("/")[-1]: r.cnt for r in c.collect()}
    assert counts == {"Mars_a": 1, "Mars_b": 3, "Mars_c": 1}
    assert most_referred(c).first().link == W + "Mars_b"
    assert most_similar(c).first().page == W + "Mars_b"


def test_distance_and_page_tie(spark):
    g = kb(spark, [("A1", "Abcd", "en"), ("A2", "Abce", "en")], [("A1", P), ("A2", P)],
           [("x", "A1"), ("y", "A2")],
           disambig=[("Abc_(disambiguation)", "A1"), ("Abc_(disambiguation)", "A2")])
    best = most_referred(candidates(reps(spark, [("abc", P, "Abc")]), g)).first().link
    assert best == W + "A1"  # same count, same distance: smaller page


def test_redirect_zero_or_one_and_language(spark):
    g = kb(spark, [("Old", "Old Name", "en"), ("New", "New", "en"), ("New", "Nouveau", "fr")],
           [("Old", P), ("New", P)], [("x", "New"), ("y", "New"), ("z", "Old")],
           redirects=[("Old", "New")])
    c = {r.item.split("/")[-1]: (r.name, r.cnt) for r in candidates(reps(spark, [("old name", P, "old name")]), g).collect()}
    # m2 = "Old Name" hits the label; the redirect branch gives Old itself (zero step) and New
    assert c == {"Old": ("Old Name", 2), "New": ("New", 2)}
    one = {r.item.split("/")[-1] for r in candidates(reps(spark, [("old name", P, "old name")]), g, redirect="one").collect()}
    assert one == {"Old", "New"}


def test_link_entities_two_labels_and_class_filter(spark):
    g = kb(spark, [("Paris", "Paris", "en"), ("Paris_Hilton", "Paris", "en")],
           [("Paris", "geo:SpatialThing"), ("Paris_Hilton", P)], [("x", "Paris"), ("y", "Paris_Hilton")])
    m = spark.createDataFrame([("d1", "Paris", "GPE"), ("d1", "Paris", "PERSON"), ("d2", "Paris", "CARDINAL")],
                              "key string, mention string, label string")
    ents, resolved = link_entities(m, g, label_class_table(spark))
    assert {(r.key, r.mention, r.link) for r in ents.collect()} == {("d1", "Paris", W + "Paris")}  # GPE < PERSON
    assert resolved.count() == 2
    # a store: nothing left to resolve, same answer
    ents2, res2 = link_entities(m, g, label_class_table(spark), store=resolved)
    assert {tuple(r) for r in ents2.collect()} == {tuple(r) for r in ents.collect()} and res2.count() == 2


def test_hot_key_split_gives_same_links(spark):
    from trawl.plans import fixtures as fx

    docs = fx.read_table(spark, "/root/testdata/sf0.001", "documents")
    g = fx.derived_kb(docs)
    m = fx.mentions(docs)
    base = {tuple(r) for r in link_entities(m, g, label_class_table(spark))[0].collect()}
    assert base
    for hot in (1, 3):  # every key hot / a mix of hot and cold keys
        got = {tuple(r) for r in link_entities(m, g, label_class_table(spark), hot_rows=hot)[0].collect()}
        assert got == base
    # with a store, counts come from this input
    _, res = link_entities(m, g, label_class_table(spark))
    got = {tuple(r) for r in link_entities(m, g, label_class_table(spark), store=res, hot_rows=2)[0].collect()}
    assert got == base


def test_bucketed_graph_tables_avoid_graph_side_shuffle(spark, tmp_path):
    from trawl.plans import fixtures as fx

    docs = fx.read_table(spark, "/root/testdata/sf0.001", "documents")
    g = fx.derived_kb(docs)
    g.save_tables(str(tmp_path / "kb"), prefix="t_kb", buckets=8)
    gb = KnowledgeGraph.load_tables(spark, "t_kb")
    m = fx.mentions(docs)
    assert {tuple(r) for r in link_entities(m, gb, label_class_table(spark))[0].collect()} == \
        {tuple(r) for r in link_entities(m, g, label_class_table(spark))[0].collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = spark.createDataFrame([("abcde", P, "Abcde")], "mention_key string, class string, rep string")
        plan = candidates(r, gb)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan


def test_cache_scope_mention_uses_first_label(spark):
    g = kb(spark, [("Paris", "Paris", "en"), ("Paris_Hilton", "Paris", "en")],
           [("Paris", "geo:SpatialThing"), ("Paris_Hilton", P)], [("x", "Paris"), ("y", "Paris_Hilton")])
    m = spark.createDataFrame([("d1", "Paris", "PERSON"), ("d2", "paris", "GPE")],
                              "key string, mention string, label string")
    ents, res = link_entities(m, g, label_class_table(spark), cache_scope="mention")
    # one resolution per mention key; the smallest (label, mention) = (GPE, paris) decides
    assert res.count() == 1
    assert {(r.key, r.link) for r in ents.collect()} == {("d1", W + "Paris"), ("d2", W + "Paris")}
