"""Where rows come from: files, tables, SELECTs, JDBC, HTTP services, and the SQL text that engines are given."""
