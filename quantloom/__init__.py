"""quantloom: declarative entity x time panel analytics on PySpark."""
