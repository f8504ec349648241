"""shoplens: shop click-log and ad-click analytics on PySpark.

``shoplens.api`` holds one lazy DataFrame -> DataFrame function per job;
``shoplens.sources`` reads the shop tables and the ad-click stream;
``shoplens.streaming`` runs the ad-click jobs on Structured Streaming;
``shoplens.sinks`` writes results.  See README.md.
"""

__version__ = "0.1.0"
