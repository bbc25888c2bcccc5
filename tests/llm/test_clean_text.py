"""The texts that quality rules return."""

from fleetrisk.llm.quality import quality_rules


def test_boilerplate_lines_are_removed(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, f"  Share THIS page \n{own(i)}\n\n\tshare this page\nend {i}", "a") for i in range(11)]
    rows += [(20, f"share this page\n{own(20)}", "b"), (21, None, "a"), (22, "share this page", None), (23, "share this page", "a")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == len(rows)
    for i in range(11):
        assert got[i].clean_text == f"{own(i)}\n\nend {i}" and got[i].n_lost_words == 6 and got[i].kept
    assert got[20].clean_text == rows[11][1] and got[21].clean_text is None and got[22].clean_text == "share this page"
    assert got[23].clean_text == "" and got[23].n_lost_words == 3 and got[23].depleted
    assert [got[i].n_lost_words for i in (20, 21, 22)] == [0, 0, 0]
