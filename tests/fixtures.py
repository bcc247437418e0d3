"""Small invented inputs. Only column names and permitted values are given; rows are made up here."""

from assaylake.catalogue import CRITICAL_FACILITIES

CSV_COLUMNS = ["Proj_ID", "Program", "Project Title", "PI Name", "Start_Date (mm/dd/yyyy)",
               "End_Date (mm/dd/yyyy)", "Budget Allocated (Php)", "Budget Utilized (Php)", "Status", "Fund Source"]
HEADER = ",".join(CSV_COLUMNS)

GOOD_A = [
    'Q-11,Health,River fly map,Dr. N. Salonga,04/03/2024,08/19/2026,"2,250,000.00","1,575,000.00",Ongoing,Counterpart',
    'Q-12,ICT,Harbour sensor mesh,Dr. P. Quiambao,07/22/2025,03/31/2027,"8,840,000.00","2,210,000.00",Ongoing,GAA',
    'Q-13,Health,Midwife kits,Dr. R. Ferrer,02/17/2026,10/05/2026,"2,400,000.00","300,000.00",Ongoing,Foreign-Assisted',
]
GOOD_B = [
    'Q-14,ICT,Tide gauge archive,Dr. S. Magno,03/09/2026,12/20/2027,"1,980,000.00","45,000.00",Proposed,Special Trust Fund',
    'Q-15,Agriculture,Cacao shade trial,Dr. V. Ocampo,5/6/2026,06/30/2028,"3,330,000.00","0.00",Proposed,GAA',
]
# ends before it starts; fine; twice; no title; twice; overspent
BAD = [
    'D-21,Agriculture,Eel hatchery,Dr. K,11/30/2025,02/14/2025,"900,000.00","120,000.00",Ongoing,Counterpart',
    'D-22,ICT,Signal flags,Dr. L,04/21/2024,09/09/2026,"1,470,000.00","1,200,000.00",Ongoing,GAA',
    'D-23,Health,Night clinic,Dr. M,08/12/2025,05/27/2026,"640,000.00","10,000.00",Ongoing,GAA',
    'D-24,ICT,,Dr. N,12/02/2024,,"310,000.00","95,500.00",Proposed,Special Trust Fund',
    'D-23,Health,Day clinic,Dr. M,08/19/2025,05/30/2026,"655,000.00","12,000.00",Ongoing,GAA',
    'D-25,Agriculture,Salt ponds,Dr. O,02/06/2023,07/18/2025,"700,000.00","701,500.00",Completed,Foreign-Assisted',
]


def write_csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")


# Each kind of finding stands in a contact column, in a remark, or in both; one person stands twice, one remark is empty.
_MAILBOXES = ["desk@ferry.example.net", "amihan@clinic.example.org", "b.cruz@example.com", "lim.e@mail.example.com"]
_CONTACTS = {  # person: phone, e-mail
    "Amihan Soriano": ("(02) 8123 4567", _MAILBOXES[1]),
    "Bayani Cruz": ("0917 555 0199", _MAILBOXES[2]),
    "Ekaterina Lim": ("+63 918 000 4321", _MAILBOXES[3]),
}
_REMARKS = {
    "p5": "Parcels for SSS 34-5678901-2 go upstairs",
    "p2": "Second desk: Atty. Luz Vera, phone 0928 777 1234; tin 111-222-333",
    "p9": "Copies to " + _MAILBOXES[0],
    "p7": "Closed on Mondays",
    "p3": "",
}
_WHO = {"p2": "Bayani Cruz", "p3": "Ekaterina Lim", "p5": "Amihan Soriano", "p7": "Amihan Soriano", "p9": "Ekaterina Lim"}
PEOPLE = [(i, f"Office {i}", f"Floor {n}, Tower {i}", f"Region {n % 3}", who, *_CONTACTS[who], _REMARKS[i])
          for n, (i, who) in enumerate(_WHO.items())]
PEOPLE_COLUMNS = ["feature_id", "name", "address", "region", "contact_person", "contact_phone", "contact_email", "remarks"]
SECRETS = [*_CONTACTS, *(c for pair in _CONTACTS.values() for c in pair), _MAILBOXES[0], "34-5678901-2", "Luz Vera", "0928 777 1234", "111-222-333"]
PEOPLE_POLICY = {
    "columns": {
        "remarks": {"serving": "replace_in_text"}, "contact_phone": {"serving": "mask_last3"},
        "contact_person": {"serving": "pseudonymize"}, "contact_email": {"serving": "mask"},
    },
    "skip_columns": ["name", "address"], "score_threshold": 0.4, "scan": "all_text",
}

# two places for every permitted kind, on a line across the permitted box; every third has a remark
_KINDS = CRITICAL_FACILITIES["attributes"]
FACILITY_KINDS = sorted(next(a["permissible_values"] for a in _KINDS if a["name"] == "facility_type"))
FACILITIES = [
    (f"T{n:02d}", f"Site {n}", kind, f"Lot {n}", 118.0 + n / 2, 6.0 + n / 2, who, *_CONTACTS[who], _REMARKS[("p9", "p2", "p7")[n // 3 % 3]] if n % 3 == 1 else "")
    for n, (kind, who) in enumerate((kind, list(_CONTACTS)[i % 3]) for i, kind in enumerate(FACILITY_KINDS * 2))]
FACILITY_VAULT = sum(3 + bool(f[-1]) for f in FACILITIES)
FACILITY_SCHEMA = ("facity_Id string, name string, facility_t string, address string, lon double, lat double, "
                   "contact_pe string, contact_ph string, contact_em string, remarks string")
