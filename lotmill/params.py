"""Parameters of the listing engine.  Lists that drive matching are fixed values; change them here only."""

from __future__ import annotations

from dataclasses import dataclass

# Source header text -> field; longer keys win.
HEADER_FIELDS = {
    "type of an": "notice_type",
    "date of auction": "auction_date",
    "date": "notice_date",
    "name of corporate debtor": "corporate_debtor",
    "name of insolvency professional": "ip_name",
    "auction notice": "notice_pdf_url",
    "reserve price": "reserve_price_raw",
    "nature of assets": "nature_of_assets",
    "last date of submission of emd": "emd_due_date",
    "details": "details_pdf_url",
}

# Labels of the numbered form, in the order of the form.
FORM_LABELS = {
    "corporate_debtor_pdf": r"1\.\s*Name of Corporate Debtor",
    "cin": r"2\.\s*CIN/LLPIN of Corporate Debtor",
    "insolvency_commencement_date_pdf": r"3\.\s*Insolvency Commencement Date",
    "process_number_pdf": r"4\.\s*Process Number",
    "liquidation_commencement_date_pdf": r"5\.\s*Liquidation Commencement Date",
    "form_type": r"6\.\s*Form is being filed for",
    "prior_notice_reference": r"6\(a\)\.\s*Auction notices issued",
    "notice_date_pdf": r"7\.\s*Date of Issue of Auction Notice in Newspapers",
    "emd_due_date_pdf": r"8\.\s*Last Date of Submission of EMD",
    "auction_date_pdf": r"9\.\s*Date of Auction",
    "reserve_price_pdf_raw": r"10\.\s*Reserve Price",
    "emd_amount_raw": r"11\.\s*EMD Amount",
    "auction_platform": r"12\.\s*Auction Platform(?!\s*\()",
    "auction_platform_other": r"12\(a\)\.\s*Auction Platform\s*\(Others\)",
    "auction_platform_url": r"14\.\s*Web address of Auction Platform",
    "nature_of_assets_pdf": r"15\.\s*Nature of Assets to be Auctioned",
    "location_raw": r"16\.\s*Location of Assets to be Auctioned",
}
FORM_END = r"Unique Number\s*-"
FORM_REQUIRED = ("cin", "emd_amount_raw", "location_raw", "nature_of_assets_pdf", "reserve_price_pdf_raw")

# Area figures in free text.
AREA = r"([\d,]+\.?\d*)\s*(sq\.?\s*(?:ft|feet|mtrs?|meters?|metres?|m)\.?|acres?|hectares?|guntas?|cents?)\b"
#: Square feet of a unit, in the order in which units are tried: by how they begin, then by what they contain.
SQFT = {"acre": 43560.0, "hectare": 107639.0, "gunta": 1089.0, "cent": 435.6, "m": 10.7639}
NUMBER = r"[\d,]+\.?\d*"
FEET = ("ft", "feet")
BEGINS = ("acre", "hectare", "gunta", "cent")

# State names and their spellings, in the order in which they are tried.
STATES = [
    ("Andhra Pradesh", ["Andhra Pradesh"]),
    ("Arunachal Pradesh", ["Arunachal Pradesh"]),
    ("Assam", ["Assam"]),
    ("Bihar", ["Bihar"]),
    ("Chhattisgarh", ["Chhattisgarh", "Chattisgarh"]),
    ("Goa", ["Goa"]),
    ("Gujarat", ["Gujarat"]),
    ("Haryana", ["Haryana"]),
    ("Himachal Pradesh", ["Himachal Pradesh"]),
    ("Jharkhand", ["Jharkhand"]),
    ("Karnataka", ["Karnataka"]),
    ("Kerala", ["Kerala"]),
    ("Madhya Pradesh", ["Madhya Pradesh"]),
    ("Maharashtra", ["Maharashtra"]),
    ("Manipur", ["Manipur"]),
    ("Meghalaya", ["Meghalaya"]),
    ("Mizoram", ["Mizoram"]),
    ("Nagaland", ["Nagaland"]),
    ("Odisha", ["Odisha", "Orissa"]),
    ("Punjab", ["Punjab"]),
    ("Rajasthan", ["Rajasthan"]),
    ("Sikkim", ["Sikkim"]),
    ("Tamil Nadu", ["Tamil Nadu"]),
    ("Telangana", ["Telangana"]),
    ("Tripura", ["Tripura"]),
    ("Uttar Pradesh", ["Uttar Pradesh"]),
    ("Uttarakhand", ["Uttarakhand", "Uttaranchal"]),
    ("West Bengal", ["West Bengal"]),
    ("Andaman and Nicobar Islands", ["Andaman and Nicobar", "Andaman & Nicobar"]),
    ("Chandigarh", ["Chandigarh"]),
    (
        "Dadra and Nagar Haveli and Daman and Diu",
        ["Dadra and Nagar Haveli and Daman and Diu", "Dadra & Nagar Haveli", "Daman and Diu", "Daman & Diu"],
    ),
    ("Delhi", ["Delhi", "NCT of Delhi", "New Delhi"]),
    ("Jammu and Kashmir", ["Jammu and Kashmir", "Jammu & Kashmir"]),
    ("Ladakh", ["Ladakh"]),
    ("Lakshadweep", ["Lakshadweep"]),
    ("Puducherry", ["Puducherry", "Pondicherry"]),
]
#: The given tables know regions, not states; they play their part.
REGIONS = [(r, [r]) for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")]

# Registrar codes in company numbers -> state of the registry file.
REGISTRAR_STATES = {
    "AN": "andaman and nicobar islands", "AP": "andhra pradesh", "AR": "arunachal pradesh", "AS": "assam", "BR": "bihar",
    "CH": "chandigarh", "CG": "chattisgarh", "DN": "dadra & nagar haveli", "DD": "daman and diu", "DL": "delhi",
    "GA": "goa", "GJ": "gujarat", "HR": "haryana", "HP": "himachal pradesh", "JK": "jammu & kashmir",
    "JH": "jharkhand", "KA": "karnataka", "KL": "kerala", "LA": "ladakh", "LD": "lakshadweep", "MP": "madhya pradesh",
    "MH": "maharashtra", "MN": "manipur", "ML": "meghalaya", "MZ": "mizoram", "NL": "nagaland", "OR": "odisha",
    "PY": "puducherry", "PB": "punjab", "RJ": "rajasthan", "SK": "sikkim", "TN": "tamil nadu", "TZ": "tamil nadu",
    "TR": "tripura", "UP": "uttar pradesh", "UK": "uttarakhand", "UA": "uttarakhand", "WB": "west bengal",
    "TG": "telangana", "TS": "telangana",
}

# Registry fields and the headers under which files carry them, in the order in which they are tried.
REGISTRY_HEADERS = {
    "company_name": ["COMPANY_NAME", "Company Name", "CompanyName"],
    "cin": ["CORPORATE_IDENTIFICATION_NUMBER", "CIN", "Corporate Identification Number"],
    "company_status": ["COMPANY_STATUS", "Company Status", "CompanyStatus"],
    "company_category": ["COMPANY_CATEGORY", "Company Category", "CompanyCategory"],
    "company_class": ["COMPANY_CLASS", "Company Class", "CompanyClass"],
    "sub_category": ["SUB_CATEGORY", "Company SubCategory", "Sub Category", "SubCategory", "CompanySubCategory"],
    "date_of_registration": ["DATE_OF_REGISTRATION", "Date of Registration", "DateOfRegistration", "CompanyRegistrationdate_date"],
    "registered_state": ["REGISTERED_STATE", "Registered State", "State", "CompanyStateCode"],
    "registrar_of_companies": ["REGISTRAR_OF_COMPANIES", "Registrar of Companies", "RegistrarOfCompanies", "CompanyROCcode"],
    "authorized_capital": ["AUTHORIZED_CAPITAL", "Authorized Capital", "AuthorizedCapital"],
    "paidup_capital": ["PAIDUP_CAPITAL", "Paidup Capital", "PaidupCapital"],
    "registered_office_address": ["REGISTERED_OFFICE_ADDRESS", "Registered Office Address", "RegisteredOfficeAddress", "Address"],
    "principal_business_activity": [
        "PRINCIPAL_BUSINESS_ACTIVITY", "Principal Business Activity", "PrincipalBusinessActivity", "Activity", "CompanyIndustrialClassification",
    ],
}
PLACEHOLDERS = ("", "NA", "N.A.", "N/A", "-")

# Classes of land, the first that matches counts.
LAND_CLASSES = [
    ("non-agricultural", r"(?i)non[\s-]?agricultural"),
    ("agricultural", r"(?i)\bagricultural\b"),
    ("industrial", r"(?i)\bindustrial\b"),
    ("residential", r"(?i)\bresidential\b"),
    ("commercial", r"(?i)\bcommercial\b"),
]
#: Phrases that tell of possession.
POSSESSION = {"physical": r"(?i)\bphysical possession\b", "symbolic": r"(?i)\bsymbolic possession\b"}
POSSESSION_SCORES = {"physical": 100, "symbolic": 40, None: 50}

# What keeps a listing out of the report, and where reported listings lie.
VEHICLES = [
    "car", "cars", "vehicle", "vehicles", "motor vehicle", "two-wheeler", "two wheeler", "four-wheeler", "four wheeler",
    "truck", "trucks", "scooter", "motorcycle", "motorbike", "auto rickshaw",
]
PLATE = r"\b[A-Z]{2}\d{1,2}[A-Z]{1,3}\d{4}\b"

IDENTITY = ("corporate_debtor", "ip_name", "notice_type", "nature_of_assets")
TRACKED = ("reserve_price", "auction_date", "notice_date", "emd_due_date")
STATUSES = ("new", "unchanged", "changed", "collision")
SECTIONS = ("top_scored", "closing_soon", "new_today", "watchlist_changes", "collisions")
NARRATIVE_KEYS = ("summary", "price_read", "risk_notes", "data_gaps")


@dataclass(frozen=True)
class Params:
    """What a user of the engine may set."""

    preferred_regions: tuple[str, ...] = ()
    included_states: tuple[str, ...] = ()
    included_keywords: tuple[str, ...] = ()
    preferred_land_classes: tuple[str, ...] = ()
    min_plot_sqft: float | None = None
    neutral: int = 50
    bonus: int = 25
    window_days: int = 120
    closing_days: int = 7
    top_n: int = 15
    enrichment_cap: int = 150
    hits_per_entity: int = 3
    base_url: str = "https://listings.example"
    zero_is_unknown: bool = False


DEFAULTS = Params()
#: For the given tables, where region and nation names stand for places.
PROXY = Params(
    preferred_regions=("ASIA", "NATION_3", "EUROPE"), included_states=("AMERICA", "MIDDLE EAST"), included_keywords=("nation_7", "nation_12", "nation_20"),
    enrichment_cap=150,
)
