"""The places that vehicles are matched to."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The watched places (name, latitude, longitude), the match
# radius in metres, and the topic names.
PLACES = (
    ("Tvrdjava", 43.323273, 21.895323),
    ("Narodno pozoriste", 43.320522, 21.900467),
    ("Palilulska rampa", 43.313094, 21.898391),
    ("Cele-kula", 43.312478, 21.924012),
    ("Dualsoft kancelarija", 43.323843, 21.929969),
    ("Elektronski fakultet", 43.330180, 21.892056),
    ("Gradska bolnica", 43.317720, 21.911314),
    ("Park Svetog Save", 43.319180, 21.919740),
)
RADIUS_M = 200.0
FCD_TOPIC = "FCD"
EMISSIONS_TOPIC = "EMISSIONS"
RESULTS_TOPIC = "ANALYSIS_RESULTS"


def places_table(spark: SparkSession, places=PLACES) -> DataFrame:
    """The dimension (name, location_lat, location_lon).

    Made from Arrow it is a local relation, so the optimizer knows its size and
    broadcasts it on that ground; no hint is given anywhere.
    """
    names, lats, lons = zip(*places)
    return spark.createDataFrame(pa.table({
        "name": pa.array(names, pa.string()),
        "location_lat": pa.array(lats, pa.float64()),
        "location_lon": pa.array(lons, pa.float64()),
    }))
