"""changelake: change-data capture on Spark. See README.md."""
