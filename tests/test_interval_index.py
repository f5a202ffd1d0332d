"""The interval index against the expanding form, and what it reads."""

import random

from conftest import make_subs
from revspine.operators.activity import PAIR_COLUMNS, active_sub_months
from revspine.operators.interval_index import LEVELS, active_in, blocks, index_windows, read_index, write_index
from revspine.operators.spine import month_bounds
from revspine.plans.mrr import revenue_windows


def _subs(spark, seed, n=120):
    r = random.Random(seed)
    day = lambda: f"{r.randrange(2015, 2024)}-{r.randrange(1, 13):02d}-{r.choice([1, 15, 28]):02d}"
    rows = [dict(created_at=day(), ended_at=day() if r.random() < 0.6 else None, status=r.choice(["active", "canceled", "past_due"]), customer_id=f"c{r.randrange(9)}", plan_amount=r.choice([100, None])) for _ in range(n)]
    return make_subs(spark, rows + rows[:5])


def test_blocks_are_a_partition_of_the_months(spark):
    ranges = [(a, b) for a in range(0, 40, 3) for b in range(a, a + 45, 4)] + [(24000, 24299), (24287, 24287), (0, (1 << 16) - 1)]
    got = spark.createDataFrame(ranges, "first_idx int, last_idx int").select("first_idx", "last_idx", blocks().alias("b")).collect()
    for r in got:
        months = sorted(m for x in r.b for m in range(x.block << x.level, (x.block + 1) << x.level))
        assert months == list(range(r.first_idx, r.last_idx + 1))
        assert len(r.b) <= 2 * max(1, (r.last_idx - r.first_idx + 1).bit_length())


def test_pairs_of_chosen_months_equal_the_expanding_form(spark, tmp_path):
    for seed in (1, 2):
        subs = _subs(spark, seed)
        windows, bounds = revenue_windows(subs, "full"), month_bounds(subs, "2024-06-01")
        every = sorted(map(str, active_sub_months(windows, bounds).collect()))
        index = index_windows(windows, bounds)
        months = list(range(2015 * 12, 2024 * 12 + 6))
        assert sorted(map(str, active_in(index, months).collect())) == every  # the whole output on request
        write_index(index, str(tmp_path / str(seed)))
        stored = read_index(spark, str(tmp_path / str(seed)), index.schema)
        chosen = [2016 * 12 + 4, 2020 * 12, 2030 * 12]
        want = [x for x in every if "datetime.date(2016, 5, 1)" in x or "datetime.date(2020, 1, 1)" in x]
        assert sorted(map(str, active_in(stored, chosen).collect())) == want and active_in(stored, []).count() == 0


def test_a_month_reads_its_own_blocks(spark, tmp_path):
    subs = _subs(spark, 3, 400)
    index = index_windows(revenue_windows(subs, "full"), month_bounds(subs, "2024-06-01"))
    write_index(index, str(tmp_path / "i"))
    stored = read_index(spark, str(tmp_path / "i"), index.schema)
    month = 2019 * 12 + 7
    found = active_in(stored, [month])
    own = stored.where(" OR ".join(f"(level = {k} AND block = {month >> k})" for k in range(LEVELS))).count()
    assert found.count() == own < stored.count() / 3  # every row that is read is a pair of the answer
    scan = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
    assert any("level" in x and "block" in x for x in scan)
    assert index.count() < active_sub_months(revenue_windows(subs, "full"), month_bounds(subs, "2024-06-01")).count() / 3


def test_columns(spark):
    subs = _subs(spark, 4, 5)
    assert active_in(index_windows(revenue_windows(subs, "full"), month_bounds(subs, "2024-06-01")), [24000]).columns == ["month_start", *PAIR_COLUMNS]
