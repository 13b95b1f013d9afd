"""What the driver has to hold: queries, their plans and threads, whatever the number of rows."""

import random

from made_up import prose, vocabulary

from passagework.llm import rules
from passagework.session import written


def test_quality_rules_take_few_jobs(spark, table):
    draw, words = random.Random(9), vocabulary()
    rows = [(i, prose(words, int(draw.lognormvariate(5, 0.6)) + 60, draw)) for i in range(300)]
    context = spark.sparkContext
    context.setLocalProperty("spark.jobGroup.id", "quality-rules-jobs")
    try:
        assert written(rules.quality_rules(table(rows)), "test-jobs").count() == 300
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("quality-rules-jobs")
    assert 0 < len(jobs) <= 60, len(jobs)
