"""Handmade sheet layouts (FIXTURES.md F2a/F2b/F2c) as {(row, col): value} dicts."""

from __future__ import annotations

from sheetmill.plans import config as C

PERIODS = ["April 2025 - June 2025", "July 2025 - Sept 2025", "October 2025 - December 2025"]
NORMALISED = ["Apr 2025 - Jun 2025", "Jul 2025 - Sep 2025", "Oct 2025 - Dec 2025"]


def component_values(pi: int, fi: int, k: int, consumption: str) -> dict[str, float]:
    base = 10.0 if consumption == C.NIL else 100.0
    df_ = base + fi + k
    nc = 20.0 + pi
    return {"DF": df_, "NC": nc, C.TOTAL: df_ + nc}


def tariff_sheet(payments=C.PAYMENT_METHODS, fuels=C.FUELS, total_inc_vat_rows=2, blank_cell=None) -> dict[tuple[int, int], object]:
    """Three payment-method sections; per section four fuel blocks side by side
    (label column + one column per period); dual fuel also has 'Total inc VAT' rows.
    ``blank_cell`` = (payment index, fuel index, consumption, component, period index) left blank."""
    cells: dict[tuple[int, int], object] = {(0, 0): "Annex 9 levels"}
    r = 2
    for pi, pay in enumerate(payments):
        cells[(r, 1)] = pay
        r += 1
        for fi, fuel in enumerate(fuels):
            cells[(r, 1 + fi * 4)] = fuel  # merged label: rest of the block blank
        r += 2  # a fully blank separator row
        for cons in (C.NIL, C.TYPICAL):
            for fi in range(len(fuels)):
                c0 = 1 + fi * 4
                cells[(r, c0)] = cons
                for k, p in enumerate(PERIODS):
                    cells[(r, c0 + 1 + k)] = p
            r += 1
            comps = ["DF", "NC", C.TOTAL, C.TOTAL_INC_VAT]
            for comp in comps:
                for fi, fuel in enumerate(fuels):
                    if comp == C.TOTAL_INC_VAT and fuel != C.DUAL_FUEL:
                        continue
                    if comp == C.TOTAL_INC_VAT and cons == C.TYPICAL and total_inc_vat_rows < 2:
                        continue
                    if comp == C.TOTAL_INC_VAT and cons == C.NIL and total_inc_vat_rows < 1:
                        continue
                    c0 = 1 + fi * 4
                    cells[(r, c0)] = comp
                    for k in range(len(PERIODS)):
                        vals = component_values(pi, fi, k, cons)
                        v = vals[C.TOTAL] * (1 + C.VAT) if comp == C.TOTAL_INC_VAT else vals[comp]
                        if blank_cell == (pi, fi, cons, comp, k):
                            continue
                        cells[(r, c0 + 1 + k)] = v
                r += 1
        r += 1
    return cells


def notes_sheet() -> dict[tuple[int, int], object]:
    return {
        (0, 0): "Notes",
        (1, 0): "These notes apply to the tables.",
        (2, 0): "Note number",
        (2, 1): "Note text",
        (3, 0): "note 1",
        (3, 1): "Figures are provisional.",
        (4, 0): "note 2",
        (4, 1): "Includes late returns.",
    }


def type_sheet(values=((2024, 1, 10, 5), (2024, 2, 12, 6), (2024, 3, 14, 7))) -> dict[tuple[int, int], object]:
    cells: dict[tuple[int, int], object] = {
        (0, 0): "Table 1.1 Heat pump installations by type",
        (1, 0): "This table shows quarterly installations.",
        (2, 0): "Source: Department registry",
        (4, 0): "Installation quarter\n",
        (4, 1): "Air-to-water heat pump installations [note 1]",
        (4, 2): "Ground/water source heat pump installations",
        (4, 3): " Total heat pump \ninstallations",
    }
    for i, (y, q, a, g) in enumerate(values):
        tag = " [note 2]" if i == 0 else ""
        cells[(5 + i, 0)] = f"{y} Q{q}{tag}"
        cells[(5 + i, 1)] = a
        cells[(5 + i, 2)] = g
        cells[(5 + i, 3)] = a + g
    return cells


def region_sheet() -> dict[tuple[int, int], object]:
    cells: dict[tuple[int, int], object] = {
        (0, 0): "Table 1.2 Heat pump installations by region",
        (1, 0): "Source: Department registry",
        (3, 0): "Installation quarter",
    }
    for j, name in enumerate(C.REGION_VALUE_VARS):
        cells[(3, 1 + j)] = name
    for i in range(2):
        cells[(4 + i, 0)] = f"2024 Q{i + 1}"
        for j in range(len(C.REGION_VALUE_VARS)):
            cells[(4 + i, 1 + j)] = 100 * i + j
    return cells
