"""Writers of tables, documents and packages."""
