"""Write fixture rows as reference-style slice files (test helper, small data only)."""

import os

from footfall.constants import MIN_FIELDS, SIGNAL_FIELD_POSITIONS
from footfall.schemas import SIGNAL_COLUMNS


def to_line(row, width=MIN_FIELDS + 1):
    by_pos = {p: n for n, p in SIGNAL_FIELD_POSITIONS.items()}
    vals = ["" if i not in by_pos or row[by_pos[i]] is None else str(row[by_pos[i]])
            for i in range(width)]
    return "|".join(vals)


def write_slice_files(rows, root, extra_lines=None):
    """rows: dicts/Rows with the signal columns; files <root>/AGG/AGG_3G_BSSAP/<latn>/sig_<stamp>.txt"""
    files = {}
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        st = d["start_time"]
        stamp = st[:10] + f"{int(st[10:12]) // 5 * 5:02d}"
        key = (d["latn_id"], stamp)
        files.setdefault(key, []).append(to_line(d))
    for (latn, stamp), lines in (extra_lines or {}).items():
        files.setdefault((latn, stamp), []).extend(lines)
    for (latn, stamp), lines in files.items():
        folder = os.path.join(root, "AGG", "AGG_3G_BSSAP", str(latn))
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"sig_{stamp}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
    return sorted({s for _, s in files})


def signal_rows(df):
    return [r.asDict() for r in df.select(*SIGNAL_COLUMNS).collect()]
