from pyspark.sql import functions as F

from debatelake.llm import url_filter as U


def brute_features(host, path):
    found = set()
    for tag, text in (("h", host), ("p", path)):
        marked = f"^{text}$" if text else ""
        found |= {(tag, marked.encode()[i : i + k]) for k in U.GRAMS for i in range(len(marked.encode()) - k + 1)}
    return found


def test_features_are_the_distinct_grams_of_each_row():
    split = [("a.com", "/x/x/x/x"), ("", ""), ("ü.de", "/"), ("a.com", "/x/x/x/x")]
    row, gram = U.features(*zip(*split))
    own = [set(gram[row == i].tolist()) for i in range(4)]
    assert [len(x) for x in own] == [len(brute_features(*s)) for s in split] and own[0] == own[3]
    assert U.features([], [])[0].size == 0


def test_model_on_hosts_that_it_has_not_seen():
    precision, recall = U.held_out_quality(U.training_urls())
    assert precision >= 0.95 and recall >= 0.35
    model = U.train_urls(U.training_urls())
    assert model.block_probabilities([""], [""])[0] < 0.5
    assert U.train_urls([("http://a.com", None)]).block_probabilities(["a.com"], ["/"])[0] < 0.5


def test_odd_urls_clashing_columns_and_empty_tables(spark):
    urls = ["x" * 100_000 + "://casino" + "y" * 100_000, None, "", "://", "http://A.com", "http://A.com", "HTTP://É.com/Á?q"]
    pages = spark.createDataFrame([(i // 2, u, "old", "old") for i, u in enumerate(urls)], "page_id int, url string, host string, verdict string")
    rows = U.filter_urls(pages, [("block", "a.com/"), ("allow", "a.com/")]).collect()
    assert len(rows) == 7 and {r.verdict for r in rows} <= {"allow", "block"}
    assert [(r.host, r.path) for r in rows] == [U.split_url(u) for u in urls]
    assert U.filter_urls(pages.where(F.lit(False)), ()).count() == 0
