"""Reading and writing tables: CSV, JDBC and named views."""
