"""Tables of words don't go through the driver, however small Spark takes them for."""

import pytest

from turnweave.plans.catalogue import QUERIES

MOST = 1000  # rows; the smallest tables have several thousand words


def sent(plan):
    """Rows of each broadcast of a plan that has run."""
    children = plan.children()
    below = [children.apply(i) for i in range(children.size())]
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        below.append(plan.executedPlan())
    elif "QueryStage" in plan.nodeName():
        below.append(plan.plan())
    own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName().startswith("BroadcastExchange") else []
    return own + [n for p in below for n in sent(p)]


@pytest.mark.parametrize("name", ["covered_regions", "text_match_spans", "region_text_matches", "inferred_boundaries", "issue_recoveries", "word_sets_left", "restricted_projections", "derived_utterances", "validated_boundaries"])
def test_words_are_not_sent_through_the_driver(spark, sf_dir, monkeypatch, name):
    frame = type(spark.range(1))
    seen, checkpoint = [], frame.checkpoint

    def watched(df, eager=True):
        out = checkpoint(df, eager)
        seen.extend(sent(df._jdf.queryExecution().executedPlan()))
        return out

    monkeypatch.setattr(frame, "checkpoint", watched)
    done = QUERIES[name](spark, sf_dir)._jdf.queryExecution()
    assert done.toRdd().count() > 0
    assert max([0, *seen, *sent(done.executedPlan())]) <= MOST
