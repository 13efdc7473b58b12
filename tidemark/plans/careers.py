"""What a horse's career was before each of its runs, and its prize money before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import scans


def career(df: DataFrame, order: list[str], prize: Column) -> DataFrame:
    """Starts, wins, seconds, thirds and top threes before a run, their rates to 4 digits, and the prize money won up to it,
    without and with its own, to 2 digits half-even. Runs without horse are one career; unknown days come last. Careers are
    scanned in blocks, so that one of any length, such as that of the runs without horse, is many tasks."""
    position, columns = F.col("finishing_position"), df.columns
    won = F.coalesce(prize.cast("double"), F.lit(0.0))
    is_so = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    before = {"starts": position.isNotNull(), "wins": position == 1, "seconds": position == 2, "thirds": position == 3, "top3": position <= 3}
    cut = scans.in_blocks(df, ["horse_id"], order, "careers")
    df = scans.scan(cut, ["horse_id"], {**{f"_{k}_before": is_so(c) for k, c in before.items()}, "_won_before": won})
    after = F.bround(F.coalesce("_won_before", F.lit(0.0)) + won, 2)
    counts = {f"career_{k}_before": F.coalesce(f"_{k}_before", F.lit(0).cast("bigint")) for k in before}
    df = df.withColumns(counts | {"career_prize_money_after": after})
    starts = F.col("career_starts_before")
    df = df.withColumns({
        "career_win_rate_before": numbers.rate(F.col("career_wins_before"), starts, 4), "career_top3_rate_before": numbers.rate(F.col("career_top3_before"), starts, 4),
        "career_prize_money_before": F.bround(F.col("career_prize_money_after") - won, 2),
    })
    made = [*counts, "career_prize_money_after", "career_win_rate_before", "career_top3_rate_before", "career_prize_money_before"]
    return df.select(*dict.fromkeys([*columns, *made]))
