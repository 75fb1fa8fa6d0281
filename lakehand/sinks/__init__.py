"""Writers: snapshot tables (SCD2 without a merge-capable format), appends, JDBC."""
