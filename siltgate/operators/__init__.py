"""DataFrame operators: checks, the gate, repeats, star schema, KPIs."""
