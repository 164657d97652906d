"""Writers for tiny raw files in each dataset layout (values are invented)."""

from __future__ import annotations

import os


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def mhealth(root: str, subjects=(1, 2)) -> str:
    d = os.path.join(root, "mhealth")
    for sid in subjects:
        lines = []
        labels = [0, 4, 13, 4, 12] if sid == 1 else [13, 1, 1]
        for i, lab in enumerate(labels):
            vals = [str(float(i + k)) for k in range(23)]
            vals[8] = "180.0"  # left_ankle_gyr_x in deg/s
            lines.append("\t".join(vals + [str(lab)]))
        _write(os.path.join(d, f"mHealth_subject{sid}.log"), "\n".join(lines) + "\n")
    _write(os.path.join(d, "README.txt"), "not data\n")
    return d


def hugadb(root: str) -> str:
    d = os.path.join(root, "hugadb", "v2")
    header = "#Activity\tWalking\n#ActivityID\t1\n" + "\t".join(f"h{i}" for i in range(39)) + "\n"
    def row(act, base):
        return " ".join(str(base + i) for i in range(38)) + f" {act}\n"
    _write(os.path.join(d, "HGD_v2_walking_03_05.txt"),
           header + row(1, 0) + row(2, 100) + "\n" + row(99, 32767 - 40))
    _write(os.path.join(d, "HGD_v2_running_03_05.txt"), header + row(2, 7))
    _write(os.path.join(d, "HGD_v2_sitting_04_01.txt"), header + row(5, 1) + row(5, 2) + row(5, 3)
           + " ".join(["1"] * 40) + "\n")
    _write(os.path.join(d, "readme.txt"), "about the data\n")
    return d


def bruno(root: str) -> str:
    d = os.path.join(root, "bruno")
    _write(os.path.join(d, "Climb_stairs", "Accelerometer-2011-03-24-10-24-39-climb_stairs-f1.txt"),
           "0 63 31\n1 2 3\n4,5,6\n7 8 9\n10 11 12\n")
    _write(os.path.join(d, "Walk", "Accelerometer-2011-03-24-10-25-44-walk-m2.txt"),
           "1 1 1\n2 2 2 2\n3 3 3\n")
    _write(os.path.join(d, "Walk", "Accelerometer-2011-03-25-10-25-44-walk-f1.txt"), "5 5 5\n")
    _write(os.path.join(d, "Brush_teeth", "Accelerometer-2011-04-11-13-28-18-brush_teeth-f1.txt"),
           "9 9 9\n")
    _write(os.path.join(d, "Climb_stairs_MODEL", "Accelerometer-2011-03-24-10-24-39-climb_stairs-f1.txt"),
           "1 1 1\n")
    _write(os.path.join(d, "Walk", "short-name-f1.txt"), "1 1 1\n")
    _write(os.path.join(d, "MANUAL.txt"), "manual\n")
    _write(os.path.join(d, "Walk", "empty-2011-03-24-10-25-44-x-walk-m9.txt"), "")
    return d


def karas(root: str) -> str:
    d = os.path.join(root, "karas", "data")
    _write(os.path.join(d, "id00b70b13.csv"),
           "activity,time_s,lw_x,lw_y,lw_z\n1,0.5,0.1,0.2,0.3\n2,2.01,1,abc,1\n5,3.0,0,0,-1\n")
    _write(os.path.join(d, "sub", "id0a.csv"),
           "Activity,Time_s,LW_Z,LW_X,LA_X\n99,1.0,2,3,4\n")
    return d


LUO_HEADER = "PacketCounter, SampleTimeFine, Acc_X, Acc_Y, Acc_Z\n"


def luo(root: str) -> str:
    d = os.path.join(root, "luo")
    # subject 1, trial 4 (flat): trunk packets 10,11,13; right_wrist 10..12
    _write(os.path.join(d, "1", "4-000_00B432CC.csv"),
           LUO_HEADER + "10, 1, 1.0, 2.0, 3.0\n11, 2, 1.1, 2.1, 3.1\n13, 3, 1.3, 2.3, 3.3\n"
           "14, 4, 1, 2, 3, 99, 98\n")
    _write(os.path.join(d, "1", "4-000_00B43295.csv"),
           "PacketCounter,Acc_Z,Acc_X\n10,9.0,7.0\n11,9.1\n12,9.2,7.2\n")
    # subject 1, trial 60 -> unknown surface
    _write(os.path.join(d, "1", "x", "60-000_00B4328B.csv"), LUO_HEADER + "5, 1, 0, 0, 0\n6, 1, 1, 1, 1\n")
    # subject 2: unknown sensor code (file rejected) and a duplicate packet
    _write(os.path.join(d, "2", "16-000_00B432ZZ.csv"), LUO_HEADER + "1, 1, 0, 0, 0\n")
    _write(os.path.join(d, "2", "17-000_00B4329B.csv"), LUO_HEADER + "1, 1, 0, 0, 0\n1, 2, 1, 1, 1\n")
    _write(os.path.join(d, "2", "18-000_00B432B6.csv"), LUO_HEADER + "7, 1, 5, 5, 5\n")
    # outside the enumerated subjects
    _write(os.path.join(d, "31", "4-000_00B432CC.csv"), LUO_HEADER + "1, 1, 0, 0, 0\n")
    return d
