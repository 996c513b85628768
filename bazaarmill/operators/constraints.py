"""The constraints of the star schema as rules: keys, references and row checks."""

from __future__ import annotations

from ..schemas import TABLES, schema
from .quality import Check, ForeignKey, NotNull, Rule, Unique

# Business limits and allowed words of the star schema.
PRIMARY_KEYS = {
    "dates": "date_key",
    "categories": "category_id",
    "subcategories": "subcategory_id",
    "bell_sizes": "bell_size_id",
    "item_grades": "grade_id",
    "loans": "loan_id",
    "bells": "bell_id",
    "sales": "sale_transaction_id",
    "items": "item_id",
    "loan_repayments": "repayment_id",
    "expenses": "expense_id",
    "cash_movements": "cash_movement_id",
}
UNIQUE = [
    ("dates", ("full_date",)),
    ("categories", ("category_name",)),
    ("subcategories", ("category_id", "subcategory_name")),
    ("bell_sizes", ("bell_size_name",)),
]
REFERENCES = [
    ("subcategories", "category_id", "categories"),
    ("loans", "loan_date_key", "dates"),
    ("bells", "purchase_date_key", "dates"),
    ("bells", "category_id", "categories"),
    ("bells", "subcategory_id", "subcategories"),
    ("bells", "bell_size_id", "bell_sizes"),
    ("bells", "loan_id", "loans"),
    ("sales", "sale_date_key", "dates"),
    ("items", "bell_id", "bells"),
    ("items", "category_id", "categories"),
    ("items", "subcategory_id", "subcategories"),
    ("items", "grade_id", "item_grades"),
    ("items", "date_added_key", "dates"),
    ("items", "date_sold_key", "dates"),
    ("items", "sale_transaction_id", "sales"),
    ("loan_repayments", "loan_id", "loans"),
    ("loan_repayments", "repayment_date_key", "dates"),
    ("expenses", "expense_date_key", "dates"),
    ("cash_movements", "movement_date_key", "dates"),
]
CHECKS = [
    ("dates", "date_key_range", "date_key BETWEEN 20000101 AND 99991231"),
    ("dates", "month", "month BETWEEN 1 AND 12"),
    ("dates", "quarter", "quarter BETWEEN 1 AND 4"),
    ("dates", "day_of_week", "day_of_week BETWEEN 1 AND 7"),
    ("subcategories", "gender", "gender IN ('Male', 'Female', 'Both')"),
    ("bell_sizes", "item_range", "max_items > min_items"),
    ("bell_sizes", "min_items", "min_items > 0"),
    ("item_grades", "valid_grades", "grade_id IN (1, 2)"),
    ("loans", "principal_range", "principal_amount BETWEEN 2000000 AND 8000000"),
    ("loans", "duration", "duration_months IN (6, 12)"),
    ("loans", "repaid_logic", "repaid_to_date <= total_repayment"),
    ("loans", "positive_amounts", "principal_amount > 0 AND total_repayment > 0 AND monthly_repayment > 0"),
    ("bells", "cost_range", "bell_cost BETWEEN 350000 AND 850000"),
    ("bells", "item_logic", "total_items = sellable_items + unsellable_items"),
    ("bells", "positive_items", "total_items > 0 AND sellable_items > 0"),
    ("sales", "total_logic", "total_amount = subtotal_amount - discount_amount"),
    ("sales", "positive_amounts", "subtotal_amount > 0 AND total_amount > 0"),
    ("sales", "payment_method", "payment_method IN ('Cash', 'Transfer', 'POS')"),
    ("items", "markup_range", "actual_markup_percent BETWEEN 20 AND 50"),
    ("items", "discount_range", "discount_percent IS NULL OR discount_percent IN (25, 40, 50)"),
    (
        "items",
        "sold_logic",
        "CASE WHEN is_sold THEN date_sold_key IS NOT NULL AND sale_transaction_id IS NOT NULL "
        "ELSE date_sold_key IS NULL AND sale_transaction_id IS NULL END",
    ),
    ("items", "positive_prices", "cost_per_item > 0 AND selling_price > 0"),
    ("loan_repayments", "payment_status", "payment_status IN ('OnTime', 'Late', 'Partial')"),
    ("loan_repayments", "positive_amounts", "scheduled_amount > 0 AND actual_amount >= 0"),
    ("loan_repayments", "late_logic", "(payment_status = 'OnTime') = (days_late IS NULL)"),
    ("expenses", "category", "expense_category IN ('Rent', 'Staff', 'Utilities', 'Transport', 'Other')"),
    ("expenses", "payment_method", "payment_method IN ('Cash', 'Transfer')"),
    ("expenses", "positive_amount", "amount > 0"),
    ("cash_movements", "account_type", "account_type IN ('Profits', 'Operations', 'Debts')"),
    ("cash_movements", "movement_type", "movement_type IN ('Deposit', 'Withdrawal', 'Transfer')"),
    (
        "cash_movements",
        "transfer_logic",
        "CASE WHEN movement_type = 'Transfer' THEN source_account IS NOT NULL AND destination_account IS NOT NULL "
        "ELSE source_account IS NULL AND destination_account IS NULL END",
    ),
    ("cash_movements", "positive_amount", "amount > 0"),
]
# Longest text that the declared columns hold.
LENGTHS = {
    ("categories", "category_name"): 50,
    ("categories", "category_description"): 200,
    ("subcategories", "subcategory_name"): 100,
    ("subcategories", "gender"): 10,
    ("bell_sizes", "bell_size_name"): 20,
    ("item_grades", "grade_name"): 20,
    ("sales", "payment_method"): 20,
    ("loan_repayments", "payment_status"): 20,
    ("expenses", "expense_category"): 50,
    ("expenses", "expense_description"): 200,
    ("expenses", "payment_method"): 20,
    ("cash_movements", "account_type"): 20,
    ("cash_movements", "movement_type"): 20,
    ("cash_movements", "source_account"): 20,
    ("cash_movements", "destination_account"): 20,
    ("cash_movements", "description"): 200,
}


def row_rules(table: str) -> list[Check | NotNull]:
    rules: list[Check | NotNull] = [Check(f"{t}.{n}", t, c) for t, n, c in CHECKS if t == table]
    if table in TABLES:
        rules += [NotNull(f"{table}.{f.name} is set", table, f.name) for f in schema(table).fields if not f.nullable]
    rules += [Check(f"{t}.{c} length", t, f"length({c}) <= {n}") for (t, c), n in LENGTHS.items() if t == table]
    return rules


def set_rules(table: str) -> tuple[list[Unique], list[ForeignKey]]:
    """Keys and references of one table."""
    unique = [Unique(f"{t} key", t, (k,)) for t, k in PRIMARY_KEYS.items() if t == table]
    unique += [Unique(f"{t} unique {'+'.join(c)}", t, c) for t, c in UNIQUE if t == table]
    return unique, [ForeignKey(f"{t}.{c} -> {p}", t, c, p, PRIMARY_KEYS[p]) for t, c, p in REFERENCES if t == table]


def all_rules() -> list[Rule]:
    tables = list(PRIMARY_KEYS)
    rules: list[Rule] = [r for t in tables for r in row_rules(t)]
    rules += [Unique(f"{t} key", t, (k,)) for t, k in PRIMARY_KEYS.items()]
    rules += [Unique(f"{t} unique {'+'.join(c)}", t, c) for t, c in UNIQUE]
    rules += [ForeignKey(f"{t}.{c} -> {p}", t, c, p, PRIMARY_KEYS[p]) for t, c, p in REFERENCES]
    return rules
