from sluice.cli import main

raise SystemExit(main())
