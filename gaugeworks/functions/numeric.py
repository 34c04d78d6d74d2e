"""Exact means, percentages and the rolling z-score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

ANOMALY_THRESHOLD = 2.5
FALLBACK_STD = 0.01


def mean_rounded(total: Column, count: Column, places: int) -> Column:
    """``total / count`` rounded half away from zero.

    Spark's own decimal ``avg`` keeps four more digits than its input, so rounding
    it rounds twice; dividing the exact sum keeps eighteen.
    """
    ratio = total.cast("decimal(22,2)") / count.cast("decimal(18,0)")
    return F.round(ratio, places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, NULL when the whole is empty."""
    share = (
        F.lit(100)
        * part.cast("decimal(18,0)")
        / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    )
    return F.round(share, places)


@dataclass(frozen=True)
class RollingStats:
    """Mean, sample deviation and z-score of a two-decimal measure in a frame.

    Everything rests on three integer sums in hundredths - count, sum, sum of
    squares - so no result depends on the order in which rows are added.
    """

    value: Column
    count: Column
    total: Column
    squares: Column

    @classmethod
    def over(cls, measure: str, frame: WindowSpec) -> dict[str, Column]:
        """The window sums to compute first, named for ``of``."""
        cents = hundredths(F.col(measure))
        return {
            f"_{measure}_n": F.count(cents).over(frame),
            f"_{measure}_s": F.sum(cents).over(frame),
            f"_{measure}_q": F.sum(cents * cents).over(frame),
        }

    @classmethod
    def of(cls, measure: str) -> RollingStats:
        return cls(
            hundredths(F.col(measure)),
            F.col(f"_{measure}_n"),
            F.col(f"_{measure}_s"),
            F.col(f"_{measure}_q"),
        )

    @property
    def _spread(self) -> Column:
        # n (n - 1) times the sample variance, an integer
        return self.count * self.squares - self.total * self.total

    @property
    def _deviation(self) -> Column:
        # n times (value - mean), an integer
        return self.count * self.value - self.total

    def mean(self) -> Column:
        return self.total / (F.lit(100.0) * F.nullif(self.count, F.lit(0)))

    def std(self) -> Column:
        """Sample deviation; a frame of fewer than two values gets the fallback."""
        pairs = self.count * (self.count - 1)
        return F.when(
            self.count >= 2, F.sqrt(self._spread / pairs.cast("double")) / F.lit(100.0)
        ).otherwise(F.lit(FALLBACK_STD))

    def zscore(self) -> Column:
        """(value - mean) / std; NULL where the frame has no variance.

        A lone value equals its mean, so its score is zero.
        """
        n = self.count.cast("double")
        deviation = self._deviation.cast("double")
        spread = F.nullif(self._spread, F.lit(0)).cast("double")
        size = F.sqrt(deviation * deviation * (n - 1) / (n * spread))
        return F.when(
            (self.count >= 2) & (self._spread > 0), F.signum(deviation) * size
        ).when((self.count == 1) & self.value.isNotNull(), F.lit(0.0))

    def is_anomaly(self, threshold: float = ANOMALY_THRESHOLD) -> Column:
        """|z| above the threshold, compared on the squared, unrounded score."""
        n = self.count.cast("double")
        deviation = self._deviation.cast("double")
        far = deviation * deviation * (n - 1) > (
            F.lit(threshold * threshold) * n * self._spread.cast("double")
        )
        return F.coalesce((self.count >= 2) & (self._spread > 0) & far, F.lit(False))


def hundredths(measure: Column) -> Column:
    return (measure * 100).cast("bigint")


def round_double(value: Column, places: int) -> Column:
    """Round half away from zero, ignoring the last bits of a double."""
    return F.round(value.cast("decimal(28,12)"), places)
