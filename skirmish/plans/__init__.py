"""Named queries over the tables of a folder, and the SQL that checks them."""
