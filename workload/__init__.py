"""The registered queries, their input views, and the SQL that checks them."""
