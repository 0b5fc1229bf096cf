"""Views and reports: declarative DataFrame plans over the catalog."""
