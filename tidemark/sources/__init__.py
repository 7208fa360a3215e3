"""Reading and writing the lake: raw loads, the commit ledger, typed layers, JDBC."""
