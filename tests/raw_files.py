"""Small raw files with the defects real extracts have, and the facts a build must find in them.

Amounts are whole numbers from a formula, so that plain Python can add up what is expected.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

COMPANIES = ["00001", "00002", "00003", "00004", "00005"]
PRODUCTS = ["VGBL", "PGBL"]


def months(first=(2013, 6), last=(2015, 7)):
    y, m = first
    while (y, m) <= last:
        yield f"{y}{m:02d}"
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)


def br(value) -> str:
    """Amount with a decimal comma."""
    return f"{value:.2f}".replace(".", ",")


def amount(kind: int, company: str, month: str, product: str) -> int:
    base = 1000 * int(company) + 7 * int(month[4:]) + (int(month[:4]) - 2012) * 100
    return base * (kind + 1) + (500 if product == "VGBL" else 0)


@dataclass
class Expected:
    contributions: dict = field(default_factory=dict)
    redemptions: dict = field(default_factory=dict)
    accepted: dict = field(default_factory=dict)
    ceded: dict = field(default_factory=dict)
    stock: dict = field(default_factory=dict)
    group: dict = field(default_factory=dict)


def write_raw_files(folder: str) -> Expected:
    """Write the nine files in windows-1252 and return what a correct build holds."""
    e = Expected()
    os.makedirs(folder, exist_ok=True)

    def save(name: str, header: list[str], lines: list[list[str | None]]) -> None:
        text = "\n".join(";".join("" if c is None else c for c in row) for row in [header, *lines]) + "\n"
        with open(os.path.join(folder, name), "wb") as f:
            f.write(text.encode("windows-1252"))

    # companies: padded codes, curly quotes, two of one name, empty group columns
    names = ["ALFA SEGUROS S.A.", "BETA UNIÃO", "GAMA – “em aprovação”", "DELTA VIDA", "DELTA VIDA"]
    save("Companies.csv", ["Coenti", "Noenti", "Cogrupo", "Nogrupo"], [[f"{c}   ", n, "", " "] for c, n in zip(COMPANIES, names, strict=True)])

    # group history: 00001 changes group, 00002 has a gap, 00003 has none, 00004/5 are generic
    history = []
    for m in months():
        g1 = ("10", "GRUPO DEZ") if m < "201409" else ("20", "GRUPO VINTE")
        history.append([m, "00001", "ALFA", *g1])
        e.group["00001", m] = (g1[0], "EXATA")
        if not "201403" <= m <= "201405":
            history.append([m, "00002", "BETA", "20", "GRUPO VINTE" if m >= "201501" else "GRUPO 20 ANTIGO"])
        e.group["00002", m] = ("20", "HERDADA" if "201403" <= m <= "201405" else "EXATA")
        e.group["00003", m] = ("NAO_INFORMADO", "NAO_INFORMADO")
        for c in ("00004", "00005"):
            history.append([m, c, "DELTA", "99999", "OUTROS GRUPOS"])
            e.group[c, m] = ("99999", "EXATA")
    history += [history[0]]  # an exact copy
    history += [["", "00001", "ALFA", "10", "GRUPO DEZ"], ["201313", "00001", "ALFA", "10", "GRUPO DEZ"]]
    history += [["201401", "00003", "GAMA – “em aprovação”", "", ""]]
    save("group_history.csv", ["damesano", "coenti", "noenti", "cogrupo", "nogrupo"], history)

    contributions, red, transfers, stock, states = [], {p: [] for p in PRODUCTS}, [], {p: [] for p in PRODUCTS}, []
    for c in COMPANIES:
        for m in months():
            for p in PRODUCTS:
                key = (c, m, p)
                if not (c == "00005" and p == "PGBL"):
                    v = amount(0, *key)
                    if key == ("00002", "201406", "VGBL"):
                        v = -250
                    if key == ("00001", "201502", "VGBL"):
                        v = 90_000_000
                    e.contributions[key] = v
                    text = br(v) + "0002" if m.endswith("03") else br(v)
                    contributions.append([c, f"{m}  ", p, text, "0"])
                if not (c == "00004" and m == "201407"):
                    v = amount(1, *key)
                    e.redemptions[key] = v
                    if m < "201312":
                        red[p].append([m, c, br(v), "0", "0"])
                    else:
                        red[p] += [[m, c, br(v - 300), br(100), "0"], [m, c, "0", br(200), br(9)]]
                    red[p] += [[m, c, "0", "0", "0"], [m, c, "0", "0", "0"]] if c == "00001" else []
                if c != "00003":
                    e.accepted[key], e.ceded[key] = amount(2, *key), amount(2, *key) - 50 * int(c)
                    transfers += [[f"{c} ", m, "R", p, br(e.accepted[key]), "3"], [f"{c} ", m, "D", p, br(e.ceded[key]), "1000000" if m == "201408" else "3"]]
                e.stock[key] = 0 if key == ("00003", "201401", "PGBL") else 40 * amount(1, *key)
                if key == ("00005", "201405", "VGBL"):
                    del e.stock[key]
                else:
                    stock[p].append([f"{c}   ", f"{m} ", br(e.stock[key])])
            if c in ("00001", "00002", "00003"):
                factor = {"00001": 1, "00002": 1.005, "00003": 1.2}[c]
                cv, rv = e.contributions[c, m, "PGBL"], e.redemptions[c, m, "PGBL"]
                states.append([c, m, "SP", br(cv * factor - 10), "", br(rv - 5), "1", "", "1"])
                states.append([c, m, "RJ", "10", "", "5", "1", "", "1"])
    states.append(["00009", "201401", "SP", "77", "", "7", "1", "", "1"])
    contributions += [["00001", "201401", "PrevTrad", "999,00", "0"], ["00001", "201402", None, "888,00", "0"], ["00001", "201399", "VGBL", "5,00", "0"]]
    contributions += [["00005", "201312", "PGBL", "1.234,56", "abc"]]
    e.contributions["00005", "201312", "PGBL"] = 0  # unreadable: NULL, outside the analysed period
    transfers += [["00001", "201401", "r", "VGBL", "1000,00", "1"], ["00001", "201401", "P", "PGBL", "2000,00", "1"]]
    transfers += [["00001", "201401", None, "VGBL", "3000,00", "1"], ["00001", "201401", "R", "", "4000,00", "1"], ["00001", "201401", "R", "PAGP", "5000,00", None]]
    transfers += [["00002", "20140", "R", "VGBL", "1,00", "1"], ["00003", "201402", "R", "VGBL", "-60,00", "0"]]
    e.accepted["00003", "201402", "VGBL"], e.ceded["00003", "201402", "VGBL"] = -60, 0
    red["VGBL"].append(["2013", "00001", "1,00", "0", "0"])

    save("contributions.csv", ["coenti", "damesano", "tipoProd", "contrib", "benef"], contributions)
    columns = ["damesano", "coenti", "resg_total", "resg_parcial", "Resg_Pag_programado"]
    for p in PRODUCTS:
        save(f"redemptions_{p.lower()}.csv", columns, red[p])
        save(f"stock_{p.lower()}.csv", ["coenti", "damesano", "fundos"], stock[p])
    save("transfers.csv", ["COENTI", "DAMESANO", "TIPOTRANSF", "TIPOPLANO", "VALOR", "QUANTIDADE"], transfers)
    save("pgbl_by_state.csv", ["COENTI", "DAMESANO", "UF", "CONTRIB", "BENEFPAGO", "RESGPAGO", "NUMPARTIC", "NUMBENEF", "NUMRESG"], states)
    return e
