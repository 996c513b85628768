"""The verification and business reports over a built warehouse, as Spark SQL.

``report(w, name)`` runs one report on the tables of ``build_warehouse``. Braced names stand for those
tables. Sides are joined by key only; Spark broadcasts the dimensions by their size.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

TABLES = (
    "dates", "categories", "subcategories", "bell_sizes", "item_grades", "loans", "bells", "sales", "items", "loan_repayments",
    "expenses", "cash_movements",
)


def share(count: str = "count(*)") -> str:
    return f"CAST({count} * 100.0 / sum({count}) OVER () AS DECIMAL(5,2))"


def day(key: str) -> str:
    """ISO text of a yyyyMMdd key."""
    k = f"CAST({key} AS VARCHAR(8))"
    return f"concat(substr({k}, 1, 4), '-', substr({k}, 5, 2), '-', substr({k}, 7, 2))"


#: Effect of a posting on its own account.
SIGNED = "CASE WHEN m.movement_type = 'Deposit' OR (m.movement_type = 'Transfer' AND m.account_type = m.destination_account) THEN m.amount ELSE -m.amount END"

REPORTS = {
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {{{t}}}" for t in TABLES) + " ORDER BY table_name",
    # Calendar
    "calendar_metrics": """SELECT count(*) AS days, count(*) FILTER (WHERE is_open) AS open_days, count(*) FILTER (WHERE NOT is_open) AS closed_days,
        count(*) FILTER (WHERE day_name = 'Sunday') AS sundays, count(*) FILTER (WHERE is_peak) AS peak_days, count(*) FILTER (WHERE is_sale) AS sale_days,
        count(*) FILTER (WHERE is_weekend) AS weekend_days FROM {dates} WHERE year = 2024""",
    "opening_schedule": """SELECT date_key, day_name, is_open, CASE WHEN is_open THEN 'OPEN' WHEN day_name = 'Sunday' THEN 'Closed - Sunday'
        WHEN date_key < 20240104 THEN 'Closed - Before Opening' ELSE 'Closed - Other' END AS status FROM {dates} WHERE year = 2024 AND month = 1 ORDER BY date_key""",
    "holiday_closures": """SELECT date_key, day_name, CASE WHEN date_key < 20240104 THEN 'Pre-Opening (Jan 1-3)' WHEN date_key = 20240329 THEN 'Good Friday'
        WHEN date_key = 20240401 THEN 'Easter Monday' WHEN date_key BETWEEN 20241225 AND 20241227 THEN 'Christmas Period' END AS holiday
        FROM {dates} WHERE year = 2024 AND NOT is_open AND day_name <> 'Sunday' ORDER BY date_key""",
    "sales_periods": """SELECT month, min(date_key) AS first_key, max(date_key) AS last_key, count(*) AS days, count(*) FILTER (WHERE is_open) AS open_days
        FROM {dates} WHERE year = 2024 AND is_sale GROUP BY month ORDER BY month""",
    "monthly_open_days": """SELECT month, month_name, count(*) AS days, count(*) FILTER (WHERE is_open) AS open_days, count(*) FILTER (WHERE is_peak) AS peak_days,
        count(*) FILTER (WHERE is_sale) AS sale_days FROM {dates} WHERE year = 2024 GROUP BY month, month_name ORDER BY month""",
    # Loans
    "loan_list": f"""SELECT loan_id, {day('loan_date_key')} AS loan_date, principal_amount, duration_months, monthly_repayment, total_repayment, interest_amount,
        effective_interest_rate FROM {{loans}} ORDER BY loan_date_key, loan_id""",
    "loan_summary": """SELECT count(*) AS loans, avg(principal_amount) AS avg_principal, sum(principal_amount) AS principal, sum(interest_amount) AS interest,
        avg(duration_months) AS avg_months, avg(effective_interest_rate) AS avg_rate FROM {loans}""",
    "repayment_by_status": f"SELECT payment_status, count(*) AS n, {share()} AS pct, avg(actual_amount) AS avg_amount FROM {{loan_repayments}} GROUP BY payment_status",
    "loan_completion": """SELECT l.loan_id, l.duration_months, coalesce(p.n, 0) AS repayments, l.total_repayment, p.paid, l.total_repayment - p.paid AS shortfall
        FROM {loans} l LEFT JOIN (SELECT loan_id, count(*) AS n, sum(actual_amount) AS paid FROM {loan_repayments} GROUP BY loan_id) p ON p.loan_id = l.loan_id""",
    "loan_dashboard": """SELECT l.loan_id, l.principal_amount, l.duration_months, l.effective_interest_rate, coalesce(p.n, 0) AS payments, p.paid,
        CASE WHEN l.is_fully_repaid THEN 'Closed' ELSE 'Active' END AS status
        FROM {loans} l LEFT JOIN (SELECT loan_id, count(*) AS n, sum(actual_amount) AS paid FROM {loan_repayments} GROUP BY loan_id) p ON p.loan_id = l.loan_id""",
    # Bells
    "funding_mix": "SELECT count(*) AS bells, count(*) FILTER (WHERE NOT is_profit_funded) AS by_loan, count(*) FILTER (WHERE is_profit_funded) AS by_profit FROM {bells}",
    "category_cost_mix": f"""SELECT c.category_name, count(*) AS bells, {share()} AS pct, min(bell_cost) AS min_cost, max(bell_cost) AS max_cost, avg(bell_cost) AS avg_cost
        FROM {{bells}} b JOIN {{categories}} c ON c.category_id = b.category_id GROUP BY c.category_name""",
    "size_tier_profile": """SELECT s.bell_size_name, count(*) AS bells, min(total_items) AS min_items, max(total_items) AS max_items, avg(total_items) AS avg_items,
        avg(sellable_percentage) * 100 AS avg_sellable_pct FROM {bells} b JOIN {bell_sizes} s ON s.bell_size_id = b.bell_size_id GROUP BY s.bell_size_name""",
    "bell_detail": f"""SELECT b.bell_id, {day('b.purchase_date_key')} AS purchased, c.category_name, v.subcategory_name, s.bell_size_name, b.total_items, b.sellable_items, b.bell_cost,
        b.cost_per_item FROM {{bells}} b JOIN {{categories}} c ON c.category_id = b.category_id
        JOIN {{subcategories}} v ON v.subcategory_id = b.subcategory_id JOIN {{bell_sizes}} s ON s.bell_size_id = b.bell_size_id ORDER BY b.bell_id LIMIT 25""",
    # Items
    "item_status_mix": f"SELECT CASE WHEN is_sold THEN 'Items Sold' ELSE 'Items Unsold' END AS status, count(*) AS n, {share()} AS pct FROM {{items}} GROUP BY is_sold",
    "grade_mix": f"SELECT g.grade_name, count(*) AS n, {share()} AS pct FROM {{items}} i JOIN {{item_grades}} g ON g.grade_id = i.grade_id GROUP BY g.grade_name",
    "discounted_items": "SELECT count(*) AS n FROM {items} WHERE is_in_discount",
    "item_sample": """SELECT i.item_id, i.bell_id, c.category_name, g.grade_name, i.selling_price, CASE WHEN i.is_sold THEN 'Sold' ELSE 'Unsold' END AS status, i.days_in_inventory, i.discount_percent
        FROM {items} i JOIN {categories} c ON c.category_id = i.category_id JOIN {item_grades} g ON g.grade_id = i.grade_id ORDER BY i.item_id LIMIT 20""",
    "category_sell_through": """SELECT c.category_name, count(*) AS items, count(*) FILTER (WHERE is_sold) AS sold, CAST(count(*) FILTER (WHERE is_sold) * 100.0 / count(*) AS DECIMAL(5,2)) AS sell_through_pct
        FROM {items} i JOIN {categories} c ON c.category_id = i.category_id GROUP BY c.category_name ORDER BY items DESC""",
    "inventory_aging": """SELECT c.category_name, count(*) AS items, avg(coalesce(i.days_in_inventory, datediff(DATE '2024-12-31', d.full_date))) AS avg_age, count(*) FILTER (WHERE is_sold) AS sold,
        count(*) FILTER (WHERE is_in_discount) AS discounted FROM {items} i JOIN {categories} c ON c.category_id = i.category_id JOIN {dates} d ON d.date_key = i.date_added_key
        GROUP BY c.category_name ORDER BY avg_age DESC""",
    # Sales
    "sales_summary": "SELECT count(*) AS sales, sum(total_amount) AS revenue, avg(total_amount) AS avg_sale, sum(discount_amount) AS discounts FROM {sales}",
    "basket_size_bands": f"""SELECT band, n, {share('n')} AS pct, avg_value FROM (SELECT CASE WHEN total_items = 1 THEN '1 item' WHEN total_items <= 4 THEN '2-4 items'
        WHEN total_items <= 8 THEN '5-8 items' WHEN total_items <= 10 THEN '9-10 items' ELSE '11+ items' END AS band, min(total_items) AS low, count(*) AS n, avg(total_amount) AS avg_value
        FROM {{sales}} GROUP BY 1) g ORDER BY low""",
    "payment_mix": f"SELECT payment_method, count(*) AS n, {share()} AS pct, sum(total_amount) AS amount FROM {{sales}} GROUP BY payment_method ORDER BY n DESC",
    "recurring_mix": f"SELECT CASE WHEN is_recurring_customer THEN 'Recurring' ELSE 'New' END AS customer_type, count(*) AS n, {share()} AS pct FROM {{sales}} GROUP BY is_recurring_customer",
    "monthly_sales": """SELECT d.month, d.month_name, sum(s.n) AS sales, sum(s.items) AS items_sold, sum(s.amount) AS revenue FROM
        (SELECT sale_date_key, count(*) AS n, sum(total_items) AS items, sum(total_amount) AS amount FROM {sales} GROUP BY sale_date_key) s JOIN {dates} d ON d.date_key = s.sale_date_key
        GROUP BY d.month, d.month_name ORDER BY d.month""",
    "monthly_revenue_sell_through": """SELECT d.month, count(*) AS sales, sum(s.total_amount) AS revenue, CAST(sum(i.sold) * 100.0 / sum(i.n) AS DECIMAL(5,2)) AS sell_through_pct FROM {sales} s
        JOIN (SELECT sale_transaction_id, count(*) AS n, count(*) FILTER (WHERE is_sold) AS sold FROM {items} WHERE sale_transaction_id IS NOT NULL GROUP BY sale_transaction_id) i
        ON i.sale_transaction_id = s.sale_transaction_id JOIN {dates} d ON d.date_key = s.sale_date_key GROUP BY d.month ORDER BY d.month""",
    "item_linkage": "SELECT count(*) FILTER (WHERE sale_transaction_id IS NOT NULL) AS linked, count(*) FILTER (WHERE is_sold AND sale_transaction_id IS NULL) AS sold_without_sale FROM {items}",
    "total_mismatches": """SELECT s.sale_transaction_id, s.total_items, i.n, s.total_amount, i.amount FROM {sales} s LEFT JOIN (SELECT sale_transaction_id, count(*) AS n, sum(final_sale_price) AS amount
        FROM {items} WHERE sale_transaction_id IS NOT NULL GROUP BY sale_transaction_id) i ON i.sale_transaction_id = s.sale_transaction_id
        WHERE abs(s.total_amount - coalesce(i.amount, 0)) > 0.01 OR s.total_items <> coalesce(i.n, 0)""",
    "transaction_sample": """SELECT s.sale_transaction_id, d.day_name, s.total_items, s.subtotal_amount, s.discount_amount, s.total_amount, s.payment_method,
        CASE WHEN s.is_recurring_customer THEN 'Yes' ELSE 'No' END AS recurring FROM {sales} s
        JOIN {dates} d ON d.date_key = s.sale_date_key ORDER BY s.sale_transaction_id LIMIT 10""",
    "first_transaction_items": """SELECT i.item_id, c.category_name, v.subcategory_name, i.final_sale_price FROM {items} i JOIN {categories} c ON c.category_id = i.category_id
        JOIN {subcategories} v ON v.subcategory_id = i.subcategory_id WHERE i.sale_transaction_id = (SELECT min(sale_transaction_id) FROM {sales})""",
    # Expenses
    "expense_summary": "SELECT count(*) AS n, sum(amount) AS amount FROM {expenses}",
    "expense_by_category": "SELECT expense_category, count(*) AS n, sum(amount) AS amount, avg(amount) AS avg_amount FROM {expenses} GROUP BY expense_category ORDER BY amount DESC",
    "expense_by_type": "SELECT CASE WHEN is_recurring THEN 'Recurring' ELSE 'Variable' END AS expense_type, count(*) AS n, sum(amount) AS amount FROM {expenses} GROUP BY is_recurring",
    "expense_by_method": "SELECT payment_method, count(*) AS n, sum(amount) AS amount FROM {expenses} GROUP BY payment_method",
    "expense_sample": f"SELECT expense_id, {day('expense_date_key')} AS expense_date, expense_category, expense_description, amount, payment_method FROM {{expenses}} ORDER BY expense_date_key, expense_id LIMIT 20",
    # Cash
    "negative_balances": """SELECT count(*) AS postings, (SELECT count(*) FROM (SELECT max_by(running_balance, cash_movement_id) AS b FROM {cash_movements}
        GROUP BY account_type, movement_date_key) e WHERE b < 0) AS day_ends FROM {cash_movements} WHERE running_balance < 0""",
    "final_balances": """SELECT m.account_type, m.running_balance FROM {cash_movements} m JOIN (SELECT account_type, max(cash_movement_id) AS last_id FROM {cash_movements}
        GROUP BY account_type) x ON x.last_id = m.cash_movement_id ORDER BY m.account_type""",
    "monthly_cash_flow": f"""SELECT year, month, account_type, sum(greatest(signed, 0)) AS inflows, sum(greatest(-signed, 0)) AS outflows
        FROM (SELECT d.year, d.month, m.account_type, {SIGNED} AS signed FROM {{cash_movements}} m JOIN {{dates}} d ON d.date_key = m.movement_date_key
        WHERE NOT (m.movement_type = 'Transfer' AND coalesce(m.description, '') ILIKE '%deficit%')) s GROUP BY year, month, account_type ORDER BY year, month, account_type""",
    "deficit_count": "SELECT count(*) AS correction_rows FROM {cash_movements} WHERE description ILIKE '%deficit correction%'",
    "cash_flow_by_account": """SELECT account_type, sum(CASE WHEN movement_type = 'Deposit' THEN amount ELSE 0 END) AS inflows, sum(CASE WHEN movement_type = 'Withdrawal' THEN amount ELSE 0 END) AS outflows
        FROM {cash_movements} GROUP BY account_type""",
}


def report(w: dict[str, DataFrame], name: str) -> DataFrame:
    sql = REPORTS[name]
    used = set(re.findall(r"\{(\w+)\}", sql))
    return w["sales"].sparkSession.sql(sql, **{t: w[t] for t in used})
