"""DataFrame operators: cleaning, rules, calendar, dimensions, facts, KPIs, audits."""
