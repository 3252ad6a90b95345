"""Vectorised Python form of the great-circle distance, for users who need a UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.columns import EARTH_RADIUS_KM


def _vectorised_haversine(radius_km: float):
    """A function made here travels to the executors whole; they need not have this package."""

    def haversine(
        lat_from: pd.Series, lon_from: pd.Series, lat_to: pd.Series, lon_to: pd.Series
    ) -> pd.Series:
        phi_from, phi_to = np.radians(lat_from), np.radians(lat_to)
        lambda_from, lambda_to = np.radians(lon_from), np.radians(lon_to)
        chord = (
            np.sin((phi_to - phi_from) / 2) ** 2
            + np.cos(phi_from) * np.cos(phi_to) * np.sin((lambda_to - lambda_from) / 2) ** 2
        ).clip(0.0, 1.0)
        return 2 * radius_km * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))

    return F.pandas_udf(haversine, T.DoubleType())


# Same distance as ``columns.haversine_km``, one Arrow batch at a time.
haversine_udf = _vectorised_haversine(EARTH_RADIUS_KM)
