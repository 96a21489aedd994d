"""chartlift: clinical data migration and quality operators as PySpark DataFrame functions."""
