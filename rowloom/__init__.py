"""rowloom: preparing, splitting and scoring labelled text datasets on PySpark."""
