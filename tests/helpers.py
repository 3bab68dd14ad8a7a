"""Small builders shared by the tests."""

import math

from rillgauge import schemas as S


def write_csv(path, columns, records):
    """Quoted CSV with a header, one line per record dict, absent fields blank."""
    lines = [",".join(columns)]
    for record in records:
        cells = (str(record.get(c, "")).replace('"', '""') for c in columns)
        lines.append(",".join(f'"{cell}"' for cell in cells))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def reading(permit, parameter, period, value, **more):
    return {
        "EXTERNAL_PERMIT_NMBR": permit,
        "PARAMETER_DESC": parameter,
        "MONITORING_PERIOD_END_DATE": period,
        "DMR_VALUE_NMBR": value,
        "DMR_VALUE_STANDARD_UNITS": value,
        "DMR_UNIT_DESC": "mg/L",
        **more,
    }


def same_rows(a, b, relative=1e-9):
    """Order-free equality: exact on everything but floats, which may differ in the last digits."""

    def split(rows):
        parts = [
            (tuple(v for v in r if not isinstance(v, float)), [v for v in r if isinstance(v, float)])
            for r in rows
        ]
        return sorted(parts, key=repr)

    left, right = split(a), split(b)
    return [k for k, _ in left] == [k for k, _ in right] and all(
        math.isclose(x, y, rel_tol=relative, abs_tol=1e-9)
        for (_, xs), (_, ys) in zip(left, right) for x, y in zip(xs, ys, strict=True)
    )


READING = (
    "EXTERNAL_PERMIT_NMBR string, MONITORING_PERIOD_END_DATE string, PARAMETER_DESC string, "
    "DMR_VALUE_STANDARD_UNITS string, year string, state string"
)
N, F_ = S.N_PARAM, S.F_PARAM
