from partflow.operators import text


def test_h18_top_terms(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.2), (2, "b", 0.8)], "doc_id bigint, term string, weight double")
    c = spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, cluster int")
    out = text.top_terms_per_cluster(w, c, n=2).collect()
    assert [(r["cluster"], r["top_terms"]) for r in out] == [(0, "a b")]


def test_tfidf_unicode_tokens_and_norm(spark):
    docs = spark.createDataFrame([(1, "Héllo wörld a héllo"), (2, "wörld x_y")], "doc_id bigint, text string")
    w = {(r["doc_id"], r["term"]): r["weight"] for r in text.tfidf(docs).collect()}
    assert set(w) == {(1, "héllo"), (1, "wörld"), (2, "wörld"), (2, "x_y")}
    assert abs(sum(v * v for (d, _), v in w.items() if d == 1) - 1.0) < 1e-12


def test_tfidf_rare_terms_by_a_join_and_texts_dealt_once(spark):
    docs = spark.createDataFrame([(k, "aa bb " + " ".join(f"w{j}" for j in range(k % 5, 9)) + f" own{k}") for k in range(40)]
                                 + [(3, "bb again"), (None, "aa null"), (None, "null bb"), (50, None), (51, "")], "doc_id bigint, text string")

    def rows(**how):
        return sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["term"], round(r["weight"], 10)) for r in text.tfidf(docs, **how).collect())

    whole = rows()
    assert len(whole) == len({(d, t) for d, t, _ in whole}) > 200
    for common in (0, 1, 3, 11):
        assert rows(common=common) == whole
    # neither the rows of common terms nor the norms are shuffled: one exchange of the texts, two of the rare rows, one of their frequencies
    plan = text.tfidf(docs, common=3)._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.split("\n") if "Window [" in line)
    assert plan[plan.index(window):].split("\n")[1].strip(" +-:").startswith("Sort") and "hashpartitioning(doc_id" in plan
