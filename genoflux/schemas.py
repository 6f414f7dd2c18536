"""Fixed schemas of tables that cross operator boundaries."""

from pyspark.sql import types as T

_KINDS = {"string": T.StringType, "bigint": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "boolean": T.BooleanType}


def struct(text: str) -> T.StructType:
    """'a string, b bigint' as a schema; needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]()) for name, kind in (x.split() for x in text.split(","))])


SPECIMEN_MIN = struct(
    "processid string, nuc string, coord string, coord_source string, country_ocean string, species string, genus string, ord bigint"
)
SEQUENCE = struct("header string, seq string, ord bigint")
CONSENSUS_META = struct("consensus_group string, cluster_id int, n_reference int")
DIAGNOSTICS = struct(
    "processid string, consensus_group string, n_assigned_to_consensus bigint, identity double, target_identity double, classic_identity double,"
    "identity_method string, matches int, mismatches int, insertions int, deletions int, edit_distance int, length_discrepancy int,"
    "runner_up_group string, runner_up_identity double, is_tie boolean, is_low_confidence boolean, status string"
)
CONSENSUS_TAXONOMY = struct(
    "consensus_group string, assigned_sp string, assignment_level string, assignment_notes string, majority_fraction double"
)
BASIN_STATS = struct(
    "basin string, n_samples bigint, lat_min double, lat_max double, lat_mean double, lon_min double, lon_max double, lon_mean double"
)
COLOR_MAP = struct("consensus_group string, consensus_group_sp string, color string, rank int")
POLYGONS = T.StructType(
    [
        T.StructField("basin_name", T.StringType()),
        T.StructField("poly_ord", T.IntegerType()),
        T.StructField("rings", T.ArrayType(T.ArrayType(struct("x double, y double")))),
        *struct("xmin double, ymin double, xmax double, ymax double").fields,
    ]
)
TREE = struct("node_id int, parent_id int, branch_length double, support double, name string, is_tip boolean")
