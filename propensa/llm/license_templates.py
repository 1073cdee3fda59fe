"""Statements of public licences, by family, and sentences that
use the same words otherwise."""

TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "This software is distributed under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "creative_commons": [
        "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-NC-SA 3.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative "
        "Commons.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "proprietary": [
        "All rights reserved.", "Copyright 2024 Example Ltd. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of "
        "the publisher.",
        "This material may not be copied, published or redistributed without permission.",
    ],
    "public_domain": [
        "This work is in the public domain.", "Released into the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0).",
    ],
}

OTHER = [
    "He lost his driving licence and had to renew it.", "The bar was granted a license to sell wine.",
    "They asked permission to enter the building.", "The general public was invited to the opening.",
    "A new version of the program was released on Monday.", "The apache helicopters flew over the valley.",
    "She studied physics at MIT before moving west.", "The software was slow and the source of many complaints.",
    "The copy of the letter was sent free of charge.", "Under the law all citizens have rights.",
    "The Mozilla browser was once widely used.", "A creative team works in the commons room.",
    "Warranty claims must be made within a year.", "The hotel reserved all rooms for the guests.",
    "The public park is in the domain of the city.", "No part of the bridge was damaged.",
]
