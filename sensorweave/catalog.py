"""Per-dataset facts: sampling rates, steps, label maps and sensor codes.

Everything in the FIXED VALUES block must equal what the six public datasets
and their established harmonised outputs use, so it is stated plainly here and
nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ----------------------------------------------------------------------------
# FIXED VALUES (must match the established harmonised outputs exactly)
# ----------------------------------------------------------------------------

STANDARD_GRAVITY = 9.80665  # m/s^2 per g

# Sampling rate (Hz) per dataset as documented in the dataset configuration.
SAMPLING_RATE_HZ = {
    "luo": 100,
    "karas": 100,
    "bruno": 32,
    "beach": 100,
    "hugadb": 58.8,
    "mhealth": 50,
}

# Grid step actually used to build each output time axis (ms).
GRID_STEP_MS = {
    "luo": 10,       # one packet
    "beach": 10,
    "hugadb": 17,
    "mhealth": 20,
}

# bruno: activity name in the file name -> surface; unmapped names are kept.
BRUNO_SURFACES = {
    "climb_stairs": "stairs_up",
    "descend_stairs": "stairs_down",
    "walk": "flat",
}

# karas: activity code -> surface; unmapped codes become null.
KARAS_SURFACES = {
    1: "flat",
    2: "stairs_up",
    3: "stairs_down",
    4: "driving",
    77: "clapping",
    99: "non-study activity",
}

# hugadb: activity id -> surface; unmapped ids become "other".
HUGADB_SURFACES = {
    1: "flat",
    2: "flat",
    3: "stairs_up",
    4: "stairs_down",
    5: "sitting",
    6: "sitting_down",
    7: "standing_up",
    8: "standing",
    9: "bicycling",
    10: "elevator_up",
    11: "elevator_down",
    12: "driving",
}

# mhealth: label -> surface; unmapped labels become null, then forward-filled.
MHEALTH_SURFACES = {
    0: "non-study activity",
    1: "standing",
    2: "sitting",
    3: "lying_down",
    4: "flat",
    5: "stairs_up",
    6: "waist_bends_forward",
    7: "frontal_elevation_arms",
    8: "knees_bending",
    9: "bicycling",
    10: "jogging",
    11: "running",
    12: "jump_front_back",
}

# luo: trial number -> surface; trials not listed become "unknown".
LUO_TRIAL_SURFACES = {
    "calibration": [1, 2, 3],
    "flat": [4, 5, 6, 7, 8, 9],
    "cobble_stone": [10, 11, 12, 13, 14, 15],
    "stairs_up": [16, 18, 20, 22, 24, 26],
    "stairs_down": [17, 19, 21, 23, 25, 27],
    "slope_up": [28, 30, 32, 34, 36, 38],
    "slope_down": [29, 31, 33, 35, 37, 39],
    "bank_left": [40, 42, 44, 46, 48, 50],
    "bank_right": [41, 43, 45, 47, 49, 51],
    "grass": [52, 53, 54, 55, 56, 57],
}

# luo: last two characters of the file stem -> sensor location.
LUO_SENSOR_CODES = {
    "CC": "trunk",
    "9B": "right_shank",
    "B6": "left_shank",
    "95": "right_wrist",
    "93": "right_thigh",
    "8B": "left_thigh",
}

# beach: the sensors looked for in every subject, in this order.
BEACH_SENSORS = [
    "left_wrist", "right_wrist",
    "left_upper_leg", "right_upper_leg",
    "left_lower_leg", "right_lower_leg",
    "left_foot", "right_foot",
]

# hugadb: the 39 whitespace-separated fields of every data line, in order.
HUGADB_COLUMNS = [
    "right_foot_acc_x", "right_foot_acc_y", "right_foot_acc_z",
    "right_foot_gyr_x", "right_foot_gyr_y", "right_foot_gyr_z",
    "right_shank_acc_x", "right_shank_acc_y", "right_shank_acc_z",
    "right_shank_gyr_x", "right_shank_gyr_y", "right_shank_gyr_z",
    "right_thigh_acc_x", "right_thigh_acc_y", "right_thigh_acc_z",
    "right_thigh_gyr_x", "right_thigh_gyr_y", "right_thigh_gyr_z",
    "left_foot_acc_x", "left_foot_acc_y", "left_foot_acc_z",
    "left_foot_gyr_x", "left_foot_gyr_y", "left_foot_gyr_z",
    "left_shank_acc_x", "left_shank_acc_y", "left_shank_acc_z",
    "left_shank_gyr_x", "left_shank_gyr_y", "left_shank_gyr_z",
    "left_thigh_acc_x", "left_thigh_acc_y", "left_thigh_acc_z",
    "left_thigh_gyr_x", "left_thigh_gyr_y", "left_thigh_gyr_z",
    "right_thigh_emg", "left_thigh_emg", "activityid",
]

# mhealth: the 24 tab-separated fields of every line, in order.
MHEALTH_COLUMNS = [
    "chest_acc_x", "chest_acc_y", "chest_acc_z",
    "chest_ecg_1", "chest_ecg_2",
    "left_ankle_acc_x", "left_ankle_acc_y", "left_ankle_acc_z",
    "left_ankle_gyr_x", "left_ankle_gyr_y", "left_ankle_gyr_z",
    "left_ankle_mag_x", "left_ankle_mag_y", "left_ankle_mag_z",
    "right_lower_acc_x", "right_lower_acc_y", "right_lower_acc_z",
    "right_lower_gyr_x", "right_lower_gyr_y", "right_lower_gyr_z",
    "right_lower_mag_x", "right_lower_mag_y", "right_lower_mag_z",
    "surface",
]

# bruno: names of the three acceleration fields after conversion.
BRUNO_COLUMNS = ["right_wrist_acc_x", "right_wrist_acc_y", "right_wrist_acc_z"]

# Names treated as metadata (not sensors) by the naming reports.
METADATA_COLUMNS = ["time_ms", "sid", "surface", "trial_no", "packetcounter"]

# Axis tokens: a column ending in one of these reports the token before it.
AXIS_TOKENS = ["x", "y", "z", "q0", "q1", "q2", "q3"]

# Expected subjects per dataset where the layout enumerates them.
EXPECTED_SUBJECTS = {"luo": (1, 30), "mhealth": (1, 10)}

# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    fs: float
    step_ms: int | None
    has_trials: bool


DATASETS = {
    "luo": DatasetSpec("luo", SAMPLING_RATE_HZ["luo"], GRID_STEP_MS["luo"], True),
    "karas": DatasetSpec("karas", SAMPLING_RATE_HZ["karas"], None, False),
    "bruno": DatasetSpec("bruno", SAMPLING_RATE_HZ["bruno"], None, True),
    "beach": DatasetSpec("beach", SAMPLING_RATE_HZ["beach"], GRID_STEP_MS["beach"], False),
    "hugadb": DatasetSpec("hugadb", SAMPLING_RATE_HZ["hugadb"], GRID_STEP_MS["hugadb"], True),
    "mhealth": DatasetSpec("mhealth", SAMPLING_RATE_HZ["mhealth"], GRID_STEP_MS["mhealth"], False),
}


def with_dataset_config(df: DataFrame, dataset_col: str = "dataset") -> DataFrame:
    """Attach ``fs``/``step_ms`` by dataset name; unknown names raise at run time.

    The configuration is six fixed rows, so it is applied as map literals
    evaluated inside the projection: no join, no shuffle, no broadcast.
    """
    name = F.col(dataset_col)
    fs_map = F.create_map(*[x for s in DATASETS.values() for x in (F.lit(s.name), F.lit(float(s.fs)))])
    step_map = F.create_map(*[x for s in DATASETS.values()
                              for x in (F.lit(s.name), F.lit(s.step_ms).cast("int"))])
    fs = F.try_element_at(fs_map, name)
    return df.withColumns({
        "fs": F.when(fs.isNull(), F.raise_error(F.concat(
            F.lit("no sampling rate for dataset "), name.cast("string")))).otherwise(fs),
        "step_ms": F.try_element_at(step_map, name),
    })
