"""DataFrame operators: filters, lookups, histories, rules, reports and updates."""
