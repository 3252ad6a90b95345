"""Labels for people: one text column per kind of result row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))


def zone_bucket_label(borough="pickup_borough", zone="pickup_zone", bucket="distance_bucket") -> Column:
    """``borough : zone - bucket``"""
    return F.concat(_name(borough), F.lit(" : "), _name(zone), F.lit(" - "), _name(bucket))


def flow_label(origin="pu_borough", destination="do_borough") -> Column:
    """``a → b``, for boroughs or zones"""
    return F.concat_ws(" → ", _name(origin), _name(destination))


def zone_hour_label(zone="zone", hour="hour") -> Column:
    """``zone (h=H)``"""
    return F.concat(_name(zone), F.lit(" (h="), F.col(hour).cast("string"), F.lit(")"))


def zone_label(zone="zone", borough="borough", key="pu_location_id") -> Column:
    """``zone (borough)``, or the id of a zone without a name"""
    named = F.concat(F.col(zone), F.lit(" ("), _name(borough), F.lit(")"))
    return F.coalesce(named, F.col(key).cast("string"))
