"""Field groups, field kinds and special values, and DataFrames of them.

The registry is small and fixed (13 groups, 72 fields), so joins with it may broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Group, its keywords, and its fields in order.
GROUPS: list[tuple[str, str, list[str], list[str]]] = [
    ("basic_info", "Basic Facility Information", ["borrower", "facility", "agreement", "tranche", "loan", "credit", "limit", "commitment", "currency", "principal"],
     ["Borrower name", "Senior facility name", "Facility name", "Type of tranche", "Currency of the facility", "Credit limit ['000]"]),
    ("sponsor_info", "Sponsor and Ownership", ["sponsor", "ownership", "shareholder", "equity", "holding", "parent", "investor", "stake", "percentage", "owned"],
     ["Is a Sponsor linked to the project?", "Sponsor Name", "Sponsor ownership [%]", "Is a HoldCo linked to the project?", "Name of the HoldCo linked to the project"]),
    ("project_details", "Project Details", ["project", "sector", "location", "country", "construction", "operation", "completion", "commercial", "NACE", "industry", "site"],
     ["Project Sector (NACE Rev. 2 classification)", "Project Sector (Aggregated)", "Project location [Country]", "Readiness [In operation / Construction needed]", "If construction needed: Readiness year", "If construction needed: Readiness month"]),
    ("construction_guarantees", "Construction and Guarantees", ["completion", "guarantee", "contractor", "EPC", "turnkey", "construction", "D&C", "fixed price", "cost overrun", "performance"],
     ["If completion guarantees specified?", "Guarantee Development sponsors name", "If D&C Contractor specified?", "Is there a fixed price, date certain, turnkey contract?", "Name of the D&C Contractor"]),
    ("revenue_mitigants", "Revenue Mitigating Factors", ["revenue", "offtake", "PPA", "power purchase", "guaranteed", "tariff", "regulated", "price", "volume", "contract", "off-taker"],
     ["If revenue mitigating factors specified?", "Type of mitigating factor", "Contractual or regulatory factor guarantor", "Revenue mitigating factors applied to", "Volume constraint type of revenue mitigating factors", "Volume covered by revenue mitigating factors [%]"]),
    ("covenants_general", "Financial Covenants - General & Reserve", ["covenant", "DSRA", "debt service reserve", "reserve account", "lock-up", "dividend", "minimum cash", "equity reserve", "distribution", "stopper", "restriction"],
     ["If DSRA (Debt Service Reserve Account) specified?", "If covenants specified?", "Covenant leading to dividend lock-up: Minimum cash, '000", "Covenant leading to dividend lock-up: Minimum Equity Reserve Account, '000"]),
    ("covenants_ratios", "Financial Covenants - Coverage & Leverage Ratios", ["DSCR", "LLCR", "ICR", "EBITDA", "coverage ratio", "leverage", "lock-up", "dividend", "debt service coverage", "loan life", "interest cover", "gearing", "debt equity"],
     ["Covenant leading to dividend lock-up: Backward-looking DSCR (B-DSCR)", "Covenant leading to dividend lock-up: Forward-looking DSCR (F-DSCR)", "Covenant leading to dividend lock-up: Loan Life Coverage Ratio (LLCR)", "Covenant leading to dividend lock-up: Interest Coverage Ratio (ICR)",
      "Covenant leading to dividend lock-up: Net Debt / EBITDA", "Covenant leading to dividend lock-up: Dividend Cover Ratio", "Covenant leading to dividend lock-up: Net Debt / RAB", "Covenant leading to dividend lock-up: Debt / Equity"]),
    ("syndication_ing", "Syndication and Participation", ["syndicate", "syndication", "ING", "participant", "lender", "bank", "commitment", "share", "proportion", "underwrite"],
     ["Is facility syndicated?", "if ING commitment specified?", "ING share [%]"]),
    ("dates_schedules", "Dates and Schedules", ["inception", "maturity", "schedule", "drawdown", "repayment", "amortization", "date", "term", "tenor", "bullet", "refinance"],
     ["Inception date [MM/YYYY] of the facility", "Maturity date [MM/YYYY] of the facility", "Is tranche expected to be refinanced?", "Principal drawdown schedule", "Principal drawdown schedule [Date: %]", "Principal repayment schedule", "Principal repayment schedule [Date: %]"]),
    ("pricing", "Interest Rates and Pricing", ["interest", "rate", "spread", "margin", "EURIBOR", "SOFR", "LIBOR", "basis points", "bps", "floor", "cap", "pricing"],
     ["Base Rate of the facility", "Tenor of the base rate / Interest Rate Tenor", "Fix interest rate [%]", "Spread [%]", "Interest rate floor %", "Interest rate cap %"]),
    ("hedging", "Hedging Arrangements", ["hedge", "hedging", "swap", "derivative", "interest rate swap", "IRS", "FX", "currency", "notional", "fixed", "floating"],
     ["Hedging: is the facility hedged?", "Hedging: how is the facility hedged", "Hedging: effective date", "Hedging: fixed rate", "Hedging: maturity date", "Hedging: notional", "Hedging: spread", "Hedging: % of exposure hedged"]),
    ("cash_sweep", "Cash Sweep Mechanism", ["cash sweep", "sweep", "excess cash", "mandatory prepayment", "cash waterfall", "surplus"],
     ["Is there a cash sweep mechanism applicable to the facility?", "Cash sweep structure", "For predetermined - additional cash to be paid [%]", "For targeted - target repayment profile [%]", "For transmission asset linked loan - sweep percentage [%]"]),
    ("fees", "Fees", ["fee", "upfront", "commitment", "arrangement", "agency", "LC fee", "letter of credit", "issuance"],
     ["Upfront Fee [%]", "Commitment fee [%]", "Letter of credit issuance fee [%]"]),
]
METADATA = ["Client Folder", "Source Files", "Comments", "Confidence Score"]
# The output columns in order.
ALL_FIELDS = [
    "Client Folder",
    "Source Files",
    "Comments",
    "Confidence Score",
    "Borrower name",
    "Senior facility name",
    "Facility name",
    "Is a Sponsor linked to the project?",
    "Sponsor Name",
    "Sponsor ownership [%]",
    "Project Sector (NACE Rev. 2 classification)",
    "Project Sector (Aggregated)",
    "Project location [Country]",
    "Is a HoldCo linked to the project?",
    "Name of the HoldCo linked to the project",
    "Readiness [In operation / Construction needed]",
    "If construction needed: Readiness year",
    "If construction needed: Readiness month",
    "If completion guarantees specified?",
    "Guarantee Development sponsors name",
    "If D&C Contractor specified?",
    "Is there a fixed price, date certain, turnkey contract?",
    "Name of the D&C Contractor",
    "If revenue mitigating factors specified?",
    "Type of mitigating factor",
    "Contractual or regulatory factor guarantor",
    "Revenue mitigating factors applied to",
    "Volume constraint type of revenue mitigating factors",
    "Volume covered by revenue mitigating factors [%]",
    "If DSRA (Debt Service Reserve Account) specified?",
    "If covenants specified?",
    "Covenant leading to dividend lock-up: Minimum cash, '000",
    "Covenant leading to dividend lock-up: Minimum Equity Reserve Account, '000",
    "Covenant leading to dividend lock-up: Backward-looking DSCR (B-DSCR)",
    "Covenant leading to dividend lock-up: Forward-looking DSCR (F-DSCR)",
    "Covenant leading to dividend lock-up: Loan Life Coverage Ratio (LLCR)",
    "Covenant leading to dividend lock-up: Interest Coverage Ratio (ICR)",
    "Covenant leading to dividend lock-up: Net Debt / EBITDA",
    "Covenant leading to dividend lock-up: Dividend Cover Ratio",
    "Covenant leading to dividend lock-up: Net Debt / RAB",
    "Covenant leading to dividend lock-up: Debt / Equity",
    "Credit limit ['000]",
    "Is facility syndicated?",
    "if ING commitment specified?",
    "ING share [%]",
    "Type of tranche",
    "Is tranche expected to be refinanced?",
    "Currency of the facility",
    "Inception date [MM/YYYY] of the facility",
    "Maturity date [MM/YYYY] of the facility",
    "Principal drawdown schedule",
    "Principal drawdown schedule [Date: %]",
    "Principal repayment schedule",
    "Principal repayment schedule [Date: %]",
    "Base Rate of the facility",
    "Tenor of the base rate / Interest Rate Tenor",
    "Fix interest rate [%]",
    "Spread [%]",
    "Interest rate floor %",
    "Interest rate cap %",
    "Hedging: is the facility hedged?",
    "Hedging: how is the facility hedged",
    "Hedging: effective date",
    "Hedging: fixed rate",
    "Hedging: maturity date",
    "Hedging: notional",
    "Hedging: spread",
    "Hedging: % of exposure hedged",
    "Is there a cash sweep mechanism applicable to the facility?",
    "Cash sweep structure",
    "For predetermined - additional cash to be paid [%]",
    "For targeted - target repayment profile [%]",
    "For transmission asset linked loan - sweep percentage [%]",
    "Upfront Fee [%]",
    "Commitment fee [%]",
    "Letter of credit issuance fee [%]",
]
FIELDS = [f for g in GROUPS for f in g[3]]
GROUP_OF = {f: g[0] for g in GROUPS for f in g[3]}
# Tokens that a model may answer with, by group.
MAX_TOKENS = {
    "basic_info": 1024,
    "sponsor_info": 768,
    "project_details": 768,
    "construction_guarantees": 768,
    "revenue_mitigants": 1024,
    "covenants_general": 768,
    "covenants_ratios": 1024,
    "syndication_ing": 512,
    "dates_schedules": 1024,
    "pricing": 768,
    "hedging": 1024,
    "cash_sweep": 768,
    "fees": 512,
}

# The kinds that the normaliser dispatches on (ratio names outside the registry included).
DATE_FIELDS = [
    "Inception date [MM/YYYY] of the facility",
    "Maturity date [MM/YYYY] of the facility",
    "Hedging: effective date",
    "Hedging: maturity date",
    "If construction needed: Readiness year",
    "If construction needed: Readiness month",
]
PERCENTAGE_FIELDS = [
    "Spread [%]",
    "Fix interest rate [%]",
    "Interest rate floor %",
    "Interest rate cap %",
    "Sponsor ownership [%]",
    "ING share [%]",
    "Hedging: fixed rate",
    "Hedging: % of exposure hedged",
    "Volume covered by revenue mitigating factors [%]",
    "For predetermined - additional cash to be paid [%]",
    "For targeted - target repayment profile [%]",
    "For transmission asset linked loan - sweep percentage [%]",
    "Upfront Fee [%]",
    "Commitment fee [%]",
    "Letter of credit issuance fee [%]",
]
RATIO_FIELDS = [
    "Covenant leading to dividend lock-up: Backward-looking DSCR (B-DSCR)",
    "Covenant leading to dividend lock-up: Forward-looking DSCR (F-DSCR)",
    "Covenant leading to dividend lock-up: Loan Life Coverage Ratio (LLCR)",
    "Covenant leading to dividend lock-up: Project Life Coverage Ratio (PLCR)",
    "Covenant leading to dividend lock-up: Interest Coverage Ratio (ICR)",
    "Covenant leading to dividend lock-up: Net Debt / EBITDA",
    "Covenant leading to default: Backward-looking DSCR (B-DSCR)",
    "Covenant leading to default: Forward-looking DSCR (F-DSCR)",
    "Covenant leading to default: Loan Life Coverage Ratio (LLCR)",
    "Covenant leading to default: Project Life Coverage Ratio (PLCR)",
    "Covenant leading to default: Interest Coverage Ratio (ICR)",
    "Covenant leading to default: Net Debt / EBITDA",
]
YES_NO_FIELDS = [
    "Is a Sponsor linked to the project?",
    "Is a HoldCo linked to the project?",
    "If completion guarantees specified?",
    "If D&C Contractor specified?",
    "Is there a fixed price, date certain, turnkey contract?",
    "If revenue mitigating factors specified?",
    "If DSRA (Debt Service Reserve Account) specified?",
    "If covenants specified?",
    "Is facility syndicated?",
    "if ING commitment specified?",
    "Is tranche expected to be refinanced?",
    "Hedging: is the facility hedged?",
    "Is there a cash sweep mechanism applicable to the facility?",
]
KIND_OF = dict.fromkeys(YES_NO_FIELDS, "yes_no") | dict.fromkeys(RATIO_FIELDS, "ratio") | dict.fromkeys(
    PERCENTAGE_FIELDS, "percentage"
) | dict.fromkeys(DATE_FIELDS, "date")

# What each operator takes for missing; they differ on purpose.
MISSING_IN_MERGE = ["NOT_FOUND", "N/A", "", "POSSIBLY_PRESENT"]
MISSING_IN_CONFIDENCE = ["NOT_FOUND", "N/A", "EXTRACTION_ERROR", "", "POSSIBLY_PRESENT"]
MISSING_IN_DEEP = ["NOT_FOUND", "N/A", "EXTRACTION_ERROR", ""]
MISSING_IN_RULES = ["NOT_FOUND", "N/A", "", "POSSIBLY_PRESENT", "EXTRACTION_ERROR"]
MISSING_IN_NORMALISER = ["", "NOT_FOUND", "N/A", "POSSIBLY_PRESENT", "NOT_EXTRACTED"]
MISSING_IN_COMPARISON = ["NOT_FOUND", "N/A", "NOT_EXTRACTED", "EXTRACTION_ERROR", "POSSIBLY_PRESENT", "", "nan", "None"]
MISSING_IN_COVERAGE = ["NOT_FOUND", "N/A", "", "NOT_EXTRACTED"]
CONFIDENCE_RANK = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
CONFIDENCE_WEIGHT = {"HIGH": 1.0, "MEDIUM": 0.6, "LOW": 0.3}


def fields(spark: SparkSession) -> DataFrame:
    """(ord, group, field, kind, description); kind is text where no canonical form is known."""
    rows = [(i, GROUP_OF[f], f, KIND_OF.get(f, "text"), describe(f)) for i, f in enumerate(FIELDS)]
    return spark.createDataFrame(rows, "ord int, group string, field string, kind string, description string")


def groups(spark: SparkSession) -> DataFrame:
    """(ord, group, name, keywords, fields, descriptions, max_tokens)."""
    rows = [(i, g, name, words, own, [describe(f) for f in own], MAX_TOKENS[g]) for i, (g, name, words, own) in enumerate(GROUPS)]
    return spark.createDataFrame(
        rows, "ord int, group string, name string, keywords array<string>, fields array<string>, descriptions array<string>, max_tokens int"
    )


# What each field holds, for prompts and for retrieval by description.
DESCRIPTIONS = {
    "Borrower name": "The legal name of the borrowing entity/company",
    "Senior facility name": "Name of the senior credit facility",
    "Facility name": "Specific name of this facility/tranche",
    "Type of tranche": "The type of credit facility: Term Loan, Revolving Loan (RCF), Letter of Credit (LC), or Bond",
    "Currency of the facility": "Currency denomination (EUR, USD, GBP, etc.)",
    "Credit limit ['000]": "Total credit limit amount with currency",
    "Is a Sponsor linked to the project?": "Yes/No - whether there's a project sponsor",
    "Sponsor Name": "Name of the sponsor entity",
    "Sponsor ownership [%]": "Percentage ownership by sponsor",
    "Is a HoldCo linked to the project?": "Yes/No - whether a holding company is involved",
    "Name of the HoldCo linked to the project": "Name of the holding company",
    "Project Sector (NACE Rev. 2 classification)": "NACE sector code and description",
    "Project Sector (Aggregated)": "Must be ONE of: Energy / Infrastructure / LNG / Manufacturing / Mining / TM / Wind and Solar",
    "Project location [Country]": "Country where the project is located",
    "Readiness [In operation / Construction needed]": "Current project status",
    "If construction needed: Readiness year": "Expected completion year",
    "If construction needed: Readiness month": "Expected completion month",
    "If completion guarantees specified?": "Yes/No - presence of completion guarantees",
    "Guarantee Development sponsors name": "Name of guarantee provider",
    "If D&C Contractor specified?": "Yes/No - presence of D&C contractor",
    "Is there a fixed price, date certain, turnkey contract?": "Yes/No - whether cost overruns are borne by contractor",
    "Name of the D&C Contractor": "Name of Design & Construction contractor or guarantor",
    "If revenue mitigating factors specified?": "Yes/No",
    "Type of mitigating factor": "Guaranteed price / Guaranteed add-on / Fix revenue component / Regulated rate-of-return / Variable OPEX passed through",
    "Contractual or regulatory factor guarantor": "Entity providing the guarantee",
    "Revenue mitigating factors applied to": "all revenues / revenues of the borrower",
    "Volume constraint type of revenue mitigating factors": "Absolute volume / % of volume covered",
    "Volume covered by revenue mitigating factors [%]": "Percentage of volume covered",
    "If DSRA (Debt Service Reserve Account) specified?": "Yes/No",
    "If covenants specified?": "Yes/No",
    "Covenant leading to dividend lock-up: Minimum cash, '000": "Minimum cash covenant",
    "Covenant leading to dividend lock-up: Minimum Equity Reserve Account, '000": "Min equity reserve",
    "Covenant leading to dividend lock-up: Backward-looking DSCR (B-DSCR)": "Historical DSCR ratio",
    "Covenant leading to dividend lock-up: Forward-looking DSCR (F-DSCR)": "Projected DSCR ratio",
    "Covenant leading to dividend lock-up: Loan Life Coverage Ratio (LLCR)": "LLCR covenant",
    "Covenant leading to dividend lock-up: Interest Coverage Ratio (ICR)": "ICR covenant",
    "Covenant leading to dividend lock-up: Net Debt / EBITDA": "Leverage ratio",
    "Covenant leading to dividend lock-up: Dividend Cover Ratio": "Dividend coverage",
    "Covenant leading to dividend lock-up: Net Debt / RAB": "Regulatory asset base ratio",
    "Covenant leading to dividend lock-up: Debt / Equity": "D/E ratio",
    "Is facility syndicated?": "Yes/No",
    "if ING commitment specified?": "Yes/No",
    "ING share [%]": "ING's percentage share - calculate if needed: (ING Amount / Total Amount)",
    "Inception date [MM/YYYY] of the facility": "Start date of facility",
    "Maturity date [MM/YYYY] of the facility": "End date of facility",
    "Is tranche expected to be refinanced?": "Yes/No",
    "Principal drawdown schedule": "Description of drawdown schedule",
    "Principal drawdown schedule [Date: %]": "Specific dates and percentages for drawdowns",
    "Principal repayment schedule": "Description of repayment schedule",
    "Principal repayment schedule [Date: %]": "Specific dates and percentages for repayments",
    "Base Rate of the facility": "Reference rate (EURIBOR, SOFR, LIBOR, etc.)",
    "Tenor of the base rate / Interest Rate Tenor": "Period for interest rate (1M, 3M, 6M, etc.)",
    "Fix interest rate [%]": "Fixed rate if no base rate",
    "Spread [%]": "Margin over base rate",
    "Interest rate floor %": "Minimum interest rate",
    "Interest rate cap %": "Maximum interest rate",
    "Hedging: is the facility hedged?": "Yes/No",
    "Hedging: how is the facility hedged": "interest rate swaps / FX swaps / inflation swaps",
    "Hedging: effective date": "Start date of hedge",
    "Hedging: fixed rate": "Fixed rate in swap",
    "Hedging: maturity date": "End date of hedge",
    "Hedging: notional": "Notional amount of hedge",
    "Hedging: spread": "Spread in hedge",
    "Hedging: % of exposure hedged": "Percentage of exposure covered",
    "Is there a cash sweep mechanism applicable to the facility?": "Yes/No",
    "Cash sweep structure": "Predetermined (% of cash) / Targeted debt balance / Transmission asset linked loan",
    "For predetermined - additional cash to be paid [%]": "Percentage of excess cash",
    "For targeted - target repayment profile [%]": "Target as % of base repayment",
    "For transmission asset linked loan - sweep percentage [%]": "Sweep percentage",
    "Upfront Fee [%]": "Initial fee percentage",
    "Commitment fee [%]": "Fee on undrawn amounts",
    "Letter of credit issuance fee [%]": "LC fee",
}


def describe(field: str) -> str:
    """What a field holds; its name where that is not known."""
    return DESCRIPTIONS.get(field, field)
