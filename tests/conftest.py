from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from barline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def hourly(spark):
    """Hourly bars by a formula of the hour, as a pandas frame; ``drop`` removes positions."""

    def make(n: int, series: str = "s", drop=()):
        hour = np.arange(n)
        close = 250 + 9 * np.sin(hour / 11) + 4 * np.cos(hour / 3.7) + hour % 17 * 0.35
        open_ = np.concatenate(([249.0], close[:-1])) + hour % 5 * 0.11 - 0.2
        pdf = pd.DataFrame({
            "series": series, "ts": pd.date_range("2024-01-01", periods=n, freq="h"), "open": open_,
            "high": np.maximum(open_, close) + 0.1 + hour % 7 * 0.05, "low": np.minimum(open_, close) - 0.1 - hour % 3 * 0.07,
            "close": close, "volume": 400.0 + hour * 37 % 211})
        return pdf.drop(index=list(drop)).reset_index(drop=True)

    return make


@pytest.fixture(scope="session")
def bars_of(spark):
    """A pandas bar frame as Spark bars."""

    def make(pdf: pd.DataFrame):
        rows = [(r.series, r.ts.to_pydatetime(), *[None if pd.isna(v) else float(v) for v in r[2:]])
                for r in pdf[["series", "ts", "open", "high", "low", "close", "volume"]].itertuples(index=False)]
        return spark.createDataFrame(
            rows, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double")

    return make
